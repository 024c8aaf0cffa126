"""Byte-level BPE: guess the tokens, check the guess, merge exactly where it fails.

A word is cut greedily into the longest tokens.  That guess is the encoding if
every two neighbours are compatible: merging the bytes of the two would never
join them across their border.  The test undoes the merges of both tokens from
the last one back, watching the two symbols at the border, for all distinct
neighbours of a batch in one array operation per step.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierframe.llm.merging import PairTable, merge_sequence, merge_words
from tierframe.llm.text import chunks

# stands between words that are guessed together; no UTF-8 text has this byte
JOINT = b"\xff"
# words above this length go through the heap one by one: the arrays take as
# many steps as the longest word has symbols
LONG_WORD = 48
# distinct words remembered by a task
REMEMBERED = 1 << 18
# The pattern that cuts text into words before the merges, with
# Unicode's White_Space written out
SPACE = r"\t-\r \x85\xa0  -     　"
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file.

    Printable Latin-1 bytes stand for themselves, the others for the characters
    from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteModel:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, step = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and not any(
            model.get(k)
            for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                      "fuse_unk", "byte_fallback", "ignore_merges")
        )
        plain &= spec["normalizer"] is None and step["type"] == "ByteLevel"
        if not plain or step["add_prefix_space"] or not step["use_regex"]:
            raise ValueError(f"{path}: only plain byte-level BPE is supported")
        value = byte_characters()
        vocab = model["vocab"]
        names = {t: bytes(value[c] for c in t) for t in vocab}
        # ranks: bytes first, then merges in their order
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        order = {t: n for n, t in enumerate(c for c in value if c in vocab)}
        for left, right in pairs:
            if left + right in order:
                raise ValueError(f"{path}: two merges give {left + right!r}")
            order[left + right] = len(order)
        self.n_bytes = len(value)
        if len([c for c in value if c in vocab]) != 256:
            raise ValueError(f"{path}: the vocabulary lacks a byte")
        self.left = np.full(len(order), -1, np.int64)
        self.right = np.full(len(order), -1, np.int64)
        for left, right in pairs:
            n = order[left + right]
            self.left[n], self.right[n] = order[left], order[right]
        merged = np.arange(self.n_bytes, len(order))
        self.pairs = PairTable(self.left[merged], self.right[merged], merged, merged)
        self.id_of = np.array([vocab[t] for t in order], np.int64)
        self.bytes_of = {vocab[t]: b for t, b in names.items()}
        self.byte = np.empty(256, np.int64)
        self.byte[[value[c] for c in value]] = [order[c] for c in value]
        # only tokens that their own bytes merge to may be guessed
        plain = [names[t] for t in order]
        own = self._exact(plain)
        self.length = np.array([len(t) for t in plain])
        self.longest = ahocorasick.Automaton()
        for n, token in enumerate(plain):
            if own[n] == [n] and token != JOINT:
                self.longest.add_word(token.decode("latin-1"), n)
        self.longest.make_automaton()
        added = spec["added_tokens"]
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
            raise ValueError(f"{path}: added tokens that take neighbours along")
        self.added = {a["content"]: a["id"] for a in added}
        self.bytes_of |= {a["id"]: a["content"].encode() for a in added}
        self.cut = regex.compile(
            "(" + "|".join(regex.escape(a) for a in sorted(self.added, key=len, reverse=True)) + ")"
        ) if added else None

    def words(self, text: str) -> list[str]:
        """Words and, as they are, the strings of added tokens."""
        if self.cut is None or not any(a in text for a in self.added):
            return WORDS.findall(text)
        out: list[str] = []
        for part in self.cut.split(text):
            out += [part] if part in self.added else WORDS.findall(part)
        return out

    def guess(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The longest token at each place of each word, and the words of these tokens.

        Works on Latin-1 text, one character per byte; the joint is in no token.
        """
        joined = JOINT.join(words).decode("latin-1")
        found = list(self.longest.iter_long(joined))
        pairs = np.fromiter(chain.from_iterable(found), np.int64, 2 * len(found)).reshape(-1, 2)
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        return pairs[:, 1], np.searchsorted(stops, pairs[:, 0], "right")

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the pairs of tokens stay apart when their bytes are merged."""
        out = np.ones(len(left), bool)
        at = np.arange(len(left))
        x, y = left.copy(), right.copy()
        limit = np.full(len(left), np.iinfo(np.int64).max)
        while len(at):
            rank, _ = self.pairs.look_up(x, y)
            joins = rank < limit
            out[at[joins]] = False
            going = ~joins & ((x >= self.n_bytes) | (y >= self.n_bytes))
            at, x, y, limit = at[going], x[going], y[going], limit[going]
            # undo the later merge; of two equal ones the right one is later, and
            # a join of its own rank would have come first
            of_x = x > y
            limit = np.where(of_x, x, y + 1)
            x, y = np.where(of_x, self.right[x], x), np.where(of_x, y, self.left[y])
        return out

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each word."""
        raw = [w.encode() for w in words]
        flat, word = self.guess(raw)
        covered = np.bincount(word, self.length[flat], len(words))
        inside = np.flatnonzero(word[1:] == word[:-1])
        keys, which = np.unique(flat[inside] << 32 | flat[inside + 1], return_inverse=True)
        good = self.compatible(keys >> 32, keys & 0xFFFFFFFF)[which]
        fails = covered != np.fromiter(map(len, raw), np.int64, len(raw))
        fails[word[inside[~good]]] = True
        out = _cut(self.id_of[flat].tolist(), np.bincount(word, minlength=len(words)))
        failed = np.flatnonzero(fails).tolist()
        for n, symbols in zip(failed, self._exact([raw[n] for n in failed], self.id_of)):
            out[n] = symbols
        return out

    def _exact(self, words: list[bytes], name: np.ndarray | None = None) -> list[list[int]]:
        """Merge the words from their bytes, short ones together; symbols, or their names."""
        out: list[list[int]] = [[]] * len(words)
        name = np.arange(len(self.left)) if name is None else name
        short = [n for n, w in enumerate(words) if len(w) <= LONG_WORD]
        for n in set(range(len(words))).difference(short):
            out[n] = name[merge_sequence(self.byte[list(words[n])].tolist(), self.pairs)].tolist()
        if short:
            sizes = [len(words[n]) for n in short]
            flat = np.frombuffer(b"".join(words[n] for n in short), np.uint8)
            symbol, word = merge_words(
                self.byte[flat], np.repeat(np.arange(len(short)), sizes), self.pairs
            )
            order = np.argsort(word, kind="stable")
            parts = _cut(name[symbol[order]].tolist(), np.bincount(word, minlength=len(short)))
            for n, part in zip(short, parts):
                out[n] = part
        return out

    def ids(self, texts: list[str], known: "Words") -> list[list[int]]:
        """Ids of whole texts; ``known`` remembers words between calls."""
        split = [self.words(t) for t in texts]
        known.learn(split)
        return [list(chain.from_iterable(map(known.ids.__getitem__, words))) for words in split]

    def digests(self, texts: list[str], known: "Words") -> tuple[list[int], list[str], list[str]]:
        """Tokens, digest of the decimal ids and digest of the decoded text of whole texts.

        The ids and the bytes that their tokens stand for are joined per word.
        """
        split = [self.words(t) for t in texts]
        known.learn(split)
        sizes, encoded, decoded = [], [], []
        for words in split:
            ids = ",".join(map(known.decimal.__getitem__, words))
            sizes.append(ids.count(",") + 1 if words else 0)
            encoded.append(_sha256(ids))
            back = b"".join(map(known.bytes.__getitem__, words))
            decoded.append(_sha256(back.decode("utf-8", "replace")))
        return sizes, encoded, decoded

    def decode(self, ids: list[int]) -> str:
        """Text of the ids, special tokens as their strings; broken UTF-8 is replaced."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _cut(flat: list, sizes: np.ndarray) -> list[list]:
    ends = np.cumsum(sizes).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


class Words:
    """What a task remembers of words: REMEMBERED at most between two calls.

    ``joined`` keeps per word the decimal ids and the bytes of its tokens, else the
    ids.  When too many come together the older half goes.
    """

    def __init__(self, model: ByteModel, joined: bool = False):
        self.model, self.joined = model, joined
        self.ids: dict[str, list[int]] = {}
        self.decimal: dict[str, str] = {}
        self.bytes: dict[str, bytes] = {}

    def learn(self, split: list[list[str]]) -> None:
        kept = self.decimal if self.joined else self.ids
        asked = {w for words in split for w in words}
        fresh = asked.difference(kept)
        if len(kept) + len(fresh) > REMEMBERED:
            for old in list(islice(kept, len(kept) // 2)):
                for part in (self.ids, self.decimal, self.bytes):
                    part.pop(old, None)
            fresh = asked.difference(kept)
        words = list(fresh)
        added = self.model.added
        for word, ids in zip(words, self.model.encode(words)):
            ids = [added[word]] if word in added else ids
            if self.joined:
                self.decimal[word] = ",".join(map(str, ids))
                self.bytes[word] = b"".join(map(self.model.bytes_of.__getitem__, ids))
            else:
                self.ids[word] = ids


@lru_cache(maxsize=2)
def byte_model(path: str) -> ByteModel:
    return ByteModel(path)


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Ids of each whole text: doc_id, ids (array of int).

    One row per row of ``docs``; a null text counts as empty, which has no ids.
    Strings of added tokens inside a text become those tokens.  ``model_path``
    has to exist on all executors.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_model(model_path)
        known = Words(model)
        for keys, texts in _pieces(batches):
            ids = model.ids(texts, known)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    rows, kind = _rows(docs, id_col, text_col)
    return rows.mapInArrow(encoded, f"doc_id {kind}, ids array<int>")


def round_trip(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode and decode each whole text, returning digests of both.

    doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 (of the decoded text in UTF-8), hex.  See ``encode`` for nulls.
    """

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_model(model_path)
        known = Words(model, joined=True)
        for keys, texts in _pieces(batches):
            sizes, encoded, decoded = model.digests(texts, known)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(sizes, pa.int64()), pa.array(encoded), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows, kind = _rows(docs, id_col, text_col)
    return rows.mapInArrow(
        digested, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return rows, rows.schema["doc_id"].dataType.simpleString()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts of a batch, some characters at a time."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for start, stop in chunks(texts, 1 << 20):
            yield batch.column("doc_id").slice(start, stop - start), texts[start:stop]
