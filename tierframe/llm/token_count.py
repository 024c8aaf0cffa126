"""Token counts of a byte-fallback piece model, by merging whole batches of words at once.

The distinct words of a batch lie one after another in flat arrays; in every step
each word merges its pair of the lowest rank, and what is left is counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierframe.llm.merging import PairTable, merge_sequence, merge_words
from tierframe.llm.text import chunks

MARK = "▁"
# words above this length go through the heap one by one: the arrays take as
# many steps as the longest word has symbols
LONG_WORD = 48
# distinct words remembered by a task
REMEMBERED = 1 << 18


class PieceModel:
    """Pieces, their merges and the cost of single characters, read from a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = "Ａ  ① "
        if model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError(f"{path}: only models that leave text as it is are supported")
        ids = range(model.get_piece_size())
        if any(model.is_unused(i) for i in ids) or not any(model.is_byte(i) for i in ids):
            raise ValueError(f"{path}: only byte-fallback models without unused pieces")
        plain = [
            i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        pieces = {model.id_to_piece(i): n for n, i in enumerate(plain)}
        scores = np.array([model.get_score(i) for i in plain])
        # equal scores share a rank, so that the leftmost pair goes first
        _, rank = np.unique(-scores, return_inverse=True)
        symbols = dict(pieces)
        for char in sorted({c for p in pieces for c in p}):
            symbols.setdefault(char, len(symbols))
        rows = [
            (symbols[p[:cut]], symbols[p[cut:]], rank[n], n)
            for p, n in pieces.items()
            for cut in range(1, len(p))
            if p[:cut] in symbols and p[cut:] in symbols
        ]
        self.pairs = PairTable(*zip(*rows))
        self.symbol = np.full(0x110000, -1, np.int32)
        for text, n in symbols.items():
            if len(text) == 1:
                self.symbol[ord(text)] = n
        # a character that is no piece costs its UTF-8 bytes
        points = np.arange(0x110000)
        size = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        single = np.array([ord(p) for p in pieces if len(p) == 1], np.int64)
        size[single] = 1
        self.size = size.astype(np.int32)
        # merged symbols cost 1; a symbol of one character costs that character
        self.cost = np.ones(len(symbols) + 1, np.int32)
        for text, n in symbols.items():
            if len(text) == 1:
                self.cost[n] = size[ord(text)]
        # no piece holds a space after something else or a line end, so words
        # start at spaces and lines are apart
        if any(MARK in p.lstrip(MARK) or "\n" in p or " " in p for p in pieces):
            raise ValueError(f"{path}: a piece crosses a space or a line end")

    WORDS = re.compile(r" *[^ \n]+| +|\n")

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        return self.WORDS.findall(" " + text.replace(MARK, " "))

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each word."""
        out = np.zeros(len(words), np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.flatnonzero(sizes > LONG_WORD):
            out[n] = self._one(words[n])
        short = np.flatnonzero(sizes <= LONG_WORD)
        if len(short):
            out[short] = self._merge([words[n] for n in short], sizes[short])
        return out

    def _points(self, text: str) -> np.ndarray:
        return np.frombuffer(text.replace(" ", MARK).encode("utf-32-le"), np.uint32)

    def _one(self, word: str) -> int:
        points = self._points(word)
        symbols = self.symbol[points]
        unknown = int(self.size[points[symbols < 0]].sum())
        merged = np.array(merge_sequence(symbols.tolist(), self.pairs), np.int64)
        return unknown + int(self.cost[merged[merged >= 0]].sum())

    def _merge(self, words: list[str], sizes: np.ndarray) -> np.ndarray:
        points = self._points("".join(words))
        word = np.repeat(np.arange(len(words)), sizes)
        symbol = self.symbol[points]
        out = np.bincount(word, np.where(symbol < 0, self.size[points], 0), len(words))
        symbol, word = merge_words(symbol, word, self.pairs)
        out += np.bincount(word, np.where(symbol < 0, 0, self.cost[symbol]), len(words))
        return out.astype(np.int64)


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def count_tokens(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
) -> DataFrame:
    """Tokens of each whole text as the library counts them, without added tokens.

    Returns one row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens and
    over_limit (n_tokens > limit).  A null text counts as empty, which has 0
    tokens.  ``model_path`` is read by every task, so it has to exist on all
    executors.  Memory of a task: one Arrow batch and REMEMBERED distinct words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        text.alias("text"),
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        known: dict[str, int] = {}
        for batch in batches:
            texts = batch.column("text").to_pylist()
            totals = np.zeros(len(texts), np.int64)
            for start, stop in chunks(texts):
                split = [model.words(t) for t in texts[start:stop]]
                fresh = list({w for words in split for w in words}.difference(known))
                if len(known) + len(fresh) > REMEMBERED:
                    known.clear()
                    fresh = list({w for words in split for w in words})
                known.update(zip(fresh, model.counts(fresh).tolist()))
                totals[start:stop] = [sum(map(known.__getitem__, words)) for words in split]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(totals)],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
