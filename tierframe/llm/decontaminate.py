"""Passages of a benchmark in training text, by a generalised suffix automaton.

The automaton holds every run of words of the items.  A document is read through
it once; after each word it knows the longest run of item words that ends there,
and so all windows of the items that do.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierframe.llm.text import fresh
from tierframe.sources.staging import materialize

LOWER = {c: c + 32 for c in range(65, 91)}
# small letters and digits of ASCII, and everything beyond it
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# bytes of a UTF-8 text: A-Z in lower case, separators as blanks
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
# words of one automaton (some 1 KB each in a Python worker); a larger benchmark
# takes one pass over the documents for each so many words
AUTOMATON_WORDS = 250_000
# a longer item is handed over in pieces that overlap by a window less a word
PIECE_WORDS = 10_000

SPAN = "struct<start:int,end:int>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


class Automaton:
    """States of all runs of words of the items; ``hits`` has the windows that end in a state.

    ``hits[state]`` lists (length, items), the longest window first; a window of it
    ends at a position if it is no longer than the run matched there.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [0], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        own: list[dict[int, set[str]]] = [{} for _ in self.next]
        for item, words in items:
            size, state = min(window, len(words)), 0
            for place, word in enumerate(words, 1):
                state = self.next[state][word]
                if place >= size:
                    at = state
                    while self.length[self.link[at]] >= size:
                        at = self.link[at]
                    own[at].setdefault(size, set()).add(item)
        self.hits: list[tuple] = [()] * len(own)
        for state in sorted(range(1, len(own)), key=self.length.__getitem__):
            found = sorted(own[state].items(), reverse=True)
            self.hits[state] = (*((n, tuple(ids)) for n, ids in found), *self.hits[self.link[state]])

    def _extend(self, last: int, word: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        there = nxt[last].get(word)
        if there is not None:
            return there if length[there] == length[last] + 1 else self._split(last, word, there)
        new = self._state(length[last] + 1, {})
        at: int | None = last
        while at is not None and word not in nxt[at]:
            nxt[at][word] = new
            at = link[at] if at else None
        if at is not None:
            there = nxt[at][word]
            link[new] = there if length[there] == length[at] + 1 else self._split(at, word, there)
        return new

    def _split(self, at: int, word: bytes, there: int) -> int:
        """The shorter runs of a state get one of their own."""
        nxt, link = self.next, self.link
        twin = self._state(self.length[at] + 1, dict(nxt[there]))
        link[twin], link[there] = link[there], twin
        while nxt[at].get(word) == there:
            nxt[at][word] = twin
            if not at:
                break
            at = link[at]
        return twin

    def _state(self, length: int, after: dict[bytes, int]) -> int:
        self.next.append(after)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def read(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of words (end exclusive, apart, in order) inside windows, and the items."""
        nxt, link, length, hits = self.next, self.link, self.length, self.hits
        root = nxt[0]
        state = matched = 0
        ranges: list[tuple[int, int]] = []
        items: set[str] = set()
        for place, word in enumerate(words, 1):
            if word in nxt[state]:
                state = nxt[state][word]
                matched += 1
            elif word not in root:
                state = matched = 0
                continue
            else:
                while word not in nxt[state]:
                    state = link[state]
                matched = length[state] + 1
                state = nxt[state][word]
            if hits[state]:
                longest = 0
                for size, ids in hits[state]:
                    if size <= matched:
                        longest = longest or size
                        items.update(ids)
                if longest:
                    ranges.append((place - longest, place))
        return joined(ranges), items


def joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching ranges as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _pieces(items: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[tuple[str, list[bytes]]]:
    """Items as words; those of a null id go by the empty string."""
    rows = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
        F.col(text_col).cast("binary").alias("text"),
    ).filter("text IS NOT NULL")
    for row in rows.toLocalIterator():
        words = words_of(bytes(row["text"]))
        step = PIECE_WORDS - (window - 1)
        for start in range(0, max(len(words) - window + 1, min(1, len(words))), step):
            yield row["item"], words[start : start + PIECE_WORDS]


def _shards(pieces: Iterator[tuple[str, list[bytes]]]) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Lists of pieces that hold AUTOMATON_WORDS words at most (one list at least)."""
    shard: list[tuple[str, list[bytes]]] = []
    size = 0
    for item, words in pieces:
        if shard and size + len(words) > AUTOMATON_WORDS:
            yield shard
            shard, size = [], 0
        shard.append((item, words))
        size += len(words)
    yield shard


_built: dict[str, Automaton] = {}


def _automaton(key: str, shard: Broadcast, window: int) -> Automaton:
    """Built once in each Python worker, which keeps the one in use."""
    if key not in _built:
        _built.clear()
        _built[key] = Automaton(shard.value, window)
    return _built[key]


def matches(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    columns: list[str] | None = None,
) -> DataFrame:
    """Where the documents repeat windows of the items.

    A window is ``window`` consecutive words of an item, or the whole item where it
    has fewer (but not none); words are runs of ASCII letters, in lower case, digits
    and characters beyond ASCII.  Returns per row of ``docs``: doc (a struct of its
    ``columns``, all by default), n_words (long), spans (the ranges of words inside occurrences of
    windows, end exclusive, overlapping or touching ones as one, in order) and items
    (ids with occurring windows as strings, sorted, each once).

    Null and empty texts have no words and no spans; items without words have no
    windows; rows of one item_id are one item; an item of a null id is listed as the
    empty string; repeated documents are judged one by one.  Empty tables give empty
    or clean results.

    A pass holds the automaton of AUTOMATON_WORDS words at most, built by each Python
    worker from a broadcast list of that size; a larger benchmark takes several
    passes, each staged for the next, with the same result.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in columns or docs.columns)).alias("doc"),
        F.col(text_col).cast("binary").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(f"array<{SPAN}>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    spark = docs.sparkSession
    for n, shard in enumerate(_shards(_pieces(items, item_id_col, item_text_col, window))):
        if n:
            rows = materialize(rows, "matches")
        rows = _matched(rows, spark.sparkContext.broadcast(shard), window)
    return rows.drop("text")


def _matched(rows: DataFrame, shard: Broadcast, window: int) -> DataFrame:
    key = uuid.uuid4().hex

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, shard, window)
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            counts, spans, ids = [], [], []
            before = (batch.column(name).to_pylist() for name in ("text", "spans", "items"))
            for text, old, known in zip(*before):
                words = words_of(text or b"")
                ranges, found = automaton.read(words)
                if old:
                    ranges = joined(ranges + [(s["start"], s["end"]) for s in old])
                counts.append(len(words))
                spans.append([{"start": s, "end": e} for s, e in ranges])
                ids.append(sorted(found.union(known)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("text"),
                    pa.array(counts, pa.int64()),
                    pa.array(spans, span),
                    pa.array(ids, pa.list_(pa.string())),
                ],
                ["doc", "text", "n_words", "spans", "items"],
            )

    return rows.mapInArrow(read, rows.schema)


def n_hit(spans: Column) -> Column:
    """Words inside the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def without_matches(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    longest: int = 10,
    share: float = 0.5,
    text_col: str = "text",
    length_col: str | None = None,
    **item_cols: str,
) -> DataFrame:
    """``docs`` without what they repeat of the items, in the columns of ``docs``.

    A document whose spans cover more than ``share`` of its words goes; of the others
    every span of ``longest`` words or more is cut out of the text, from the first
    character of its first word to the last one of its last.  ``length_col``, if
    given, becomes the length of what is left.  All else stays as it is: null texts,
    texts without words, separators around a cut.
    """
    found = matches(docs, items, window, text_col, **item_cols)
    kept = found.filter(n_hit(F.col("spans")) <= F.lit(share) * F.col("n_words"))
    long = F.filter("spans", lambda s: s["end"] - s["start"] >= longest)
    cut = fresh(docs, "cut")
    rows = kept.select("doc.*", long.alias(cut))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            for n, spans in enumerate(batch.column(cut).to_pylist()):
                if spans:
                    texts[n] = without(texts[n], [(s["start"], s["end"]) for s in spans])
            at = batch.schema.get_field_index(text_col)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = rows.mapInArrow(clean, rows.schema).drop(cut)
    if length_col:
        out = out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return out


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without these ranges of words."""
    places = [m.span() for m in WORD.finditer(text.translate(LOWER))]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "".join([*out, text[at:]])
