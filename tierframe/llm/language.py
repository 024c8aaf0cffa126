"""Language identification by n-gram filters that answer for all languages at once.

A Bloom filter whose slots hold one bit per language: the slots of an n-gram, put
together by AND, are the bitmask of the languages that have it.  The bits are
counted per language over all n-grams of a text and corrected for the false
positives that the filling of the filter leads to expect.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierframe.llm.text import chunks, flat_points
from tierframe.sources.staging import materialize

ORDERS = (1, 2, 3, 4)
# different texts per language that are learnt from, about, by hash of the text
SAMPLE = 1500
# a language has an n-gram if this share of its documents has it, and at least
# this part of the share in the language where it is most common
LEAST_SHARE = 0.01
LEAST_PART = 0.2
SLOTS = 1 << 18
PROBES = 2
UNKNOWN = "und"
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Whether each code point is a letter, and the letter in lower case."""
    is_letter = np.zeros(0x110000, bool)
    lower = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            is_letter[point] = True
            small = char.lower()
            lower[point] = ord(small) if len(small) == 1 else point
    return is_letter, lower


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of words, the text of each, and the letters per text.

    A word is a run of letters; the place before and after it is a letter of its
    own, so that starts and ends count.
    """
    is_letter, lower = _letters()
    points, lengths = flat_points([f" {t} " for t in texts])
    letter = is_letter[points]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    n_letters = np.bincount(owner[letter], minlength=len(texts))
    # of a run of other characters only the last one stays
    keep = letter | np.r_[letter[1:], False]
    tail = np.r_[False, letter[:-1]] & ~letter
    keep |= tail
    symbols, owner, letter = lower[points[keep]].astype(np.uint64), owner[keep], letter[keep]
    # an n-gram ends at a letter or the place after one, and holds no inner border
    gap = np.cumsum(~letter)
    hashes, owners = [], []
    for n in ORDERS:
        m = len(symbols) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        for at in range(n):
            h = (h ^ symbols[at : at + m]) * np.uint64(_SEEDS[0])
            h ^= h >> np.uint64(32)
        inner = gap[n - 2 : n - 2 + m] - gap[:m] if n > 2 else np.zeros(m, np.int64)
        inside = (inner == 0) & (owner[:m] == owner[n - 1 :])
        inside &= letter[:m] if n == 1 else (letter[:m] | letter[1 : m + 1])
        hashes.append(h[inside])
        owners.append(owner[:m][inside])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int32), n_letters
    return np.concatenate(hashes), np.concatenate(owners), n_letters


def slots(hashes: np.ndarray, probe: int, n_slots: int) -> np.ndarray:
    return (hashes * np.uint64(_SEEDS[probe]) >> np.uint64(40)).astype(np.int64) % n_slots


@dataclass
class LanguageModel:
    """Bitmasks of the slots, one byte column per eight languages."""

    languages: list[str]
    masks: np.ndarray

    def __post_init__(self):
        bits = (self.masks[:, :, None] >> np.arange(8, dtype=np.uint8)) & 1
        filled = bits.reshape(len(self.masks), -1)[:, : len(self.languages)].mean(axis=0)
        self.false = np.minimum(filled**PROBES, 0.999)
        self.bits = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and its share of all corrected counts."""
        hashes, owner, n_letters = grams(texts)
        at = [slots(hashes, probe, len(self.masks)) for probe in range(PROBES)]
        counts = np.zeros((len(texts), 8 * self.masks.shape[1]))
        for column in range(self.masks.shape[1]):
            mask = self.masks[at[0], column]
            for more in at[1:]:
                mask = mask & self.masks[more, column]
            table = np.bincount(owner.astype(np.int64) * 256 + mask, minlength=256 * len(texts))
            counts[:, 8 * column : 8 * column + 8] = table.reshape(-1, 256) @ self.bits
        total = np.bincount(owner, minlength=len(texts))[:, None]
        counts = (counts[:, : len(self.languages)] - total * self.false) / (1 - self.false)
        counts = np.maximum(counts, 0)
        best = counts.argmax(axis=1)
        score = counts.max(axis=1) / np.maximum(counts.sum(axis=1), 1e-12)
        known = n_letters > 0
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, np.where(known, np.clip(score, 0, 1), 0.0)


def learn(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE
) -> LanguageModel | None:
    """Filter from texts of known language; null texts and languages are left out.

    About ``sample`` different texts per language are read, chosen by a hash of
    the text, once each however many copies there are; their n-grams are counted over whole texts.  What comes to the driver is
    one row per language and one per filled slot, at most SLOTS.  None if there
    is nothing to learn from.
    """
    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        "text IS NOT NULL AND lang IS NOT NULL"
    )
    # the table of languages is as long as the list of answers of the model
    place = F.xxhash64("text")
    texts = known.select("lang", place.alias("place")).distinct()
    sizes = {r.lang: r["count"] for r in texts.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return None
    place = F.pmod(place, F.lit(1 << 20)) / (1 << 20)
    share = F.create_map(*[F.lit(v) for s in languages for v in (s, min(1.0, sample / sizes[s]))])
    number = F.create_map(*[F.lit(v) for n, s in enumerate(languages) for v in (s, n)])
    # copies are drawn together, so they may as well go after the draw
    chosen = known.filter(place < share[F.col("lang")]).distinct().select(
        number[F.col("lang")].alias("lang"), "text"
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lang = batch.column("text").to_pylist(), batch.column("lang").to_numpy()
            for start, stop in chunks(texts):
                hashes, owner, n_letters = grams(texts[start:stop])
                part = lang[start:stop]
                # once per document, then documents per language
                order = np.lexsort((hashes, owner))
                hashes, owner = hashes[order], owner[order]
                new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]
                hashes, of = hashes[new[: len(hashes)]], part[owner[new[: len(hashes)]]]
                for n in np.unique(part):
                    gram, count = np.unique(hashes[of == n], return_counts=True)
                    count = np.append(count, (n_letters[part == n] > 0).sum())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(count), n, np.int32)),
                            # 0 stands for the documents themselves
                            pa.array(np.append(gram.view(np.int64), 0)),
                            pa.array(count.astype(np.int64)),
                        ],
                        ["lang", "gram", "n"],
                    )

    counts = materialize(
        chosen.mapInArrow(counted, "lang int, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")),
        "grams",
    )
    totals = counts.filter("gram = 0").select("lang", F.col("n").alias("total"))
    rates = counts.filter("gram != 0").join(F.broadcast(totals), "lang").select(
        "gram", "lang", (F.col("n") / F.col("total")).alias("rate")
    ).filter(F.col("rate") >= LEAST_SHARE)
    most = rates.groupBy("gram").agg(F.max("rate").alias("most"))
    owned = rates.join(most, "gram").filter(F.col("rate") >= LEAST_PART * F.col("most"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram = batch.column("gram").to_numpy().view(np.uint64)
            for probe in range(PROBES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots(gram, probe, SLOTS)), batch.column("lang")], ["slot", "lang"]
                )

    filled = owned.select("gram", "lang").mapInArrow(placed, "slot long, lang int").distinct()
    masks = np.zeros((SLOTS, (len(languages) + 7) // 8), np.uint8)
    rows = filled.groupBy("slot").agg(F.collect_set("lang").alias("langs")).toPandas()
    for slot, langs in zip(rows.slot, rows.langs):
        for n in langs:
            masks[slot, n // 8] |= 1 << (n % 8)
    return LanguageModel(languages, masks)


def identify(
    docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Language of each whole text: doc_id, lang_pred and score (0 to 1).

    One row per row of ``docs``.  A text that is null, or without a letter, is
    ``und`` with score 0; so is everything without a model.  Ties go to the
    first language in order.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, stop in chunks(texts):
                part = texts[start:stop]
                if model is None:
                    names, score = [UNKNOWN] * len(part), np.zeros(len(part))
                else:
                    names, score = model.predict(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, len(part)),
                        pa.array(names, pa.string()),
                        pa.array(score),
                    ],
                    ["doc_id", "lang_pred", "score"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predicted, f"doc_id {kind}, lang_pred string, score double")
