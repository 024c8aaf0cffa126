"""Remove multi-line passages that repeat anywhere in the corpus.

The lines of a document are cut into chunks where a rolling hash over the last
line hashes says so.  The cuts depend on nothing but the lines around them, so a
passage that was moved, or has other text before it, is cut in the same places.
Chunks are matched by hash over the whole corpus and compared byte by byte with
the first one before they go.

Chunks this small lose lines: a chunk of one line is not looked up, and one that
begins before a passage matches nowhere.  ``without_repeats`` therefore looks up every
two neighbouring lines and every long line instead, by the same steps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierframe.llm.text import WORD, n_words, row_key
from tierframe.sources.staging import materialize

# the rolling hash covers WINDOW lines; a chunk ends where it is 0 modulo CUT
WINDOW = 2
CUT = 2
BASE = 31
LEAST_LINES = 2
# a single line of so many words is a passage of its own
LEAST_WORDS = 50


def line_hash(line: Column) -> Column:
    """32 bits of the md5, which other engines have as well."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def with_chunks(docs: DataFrame, text: str, window: int = WINDOW, cut: int = CUT) -> DataFrame:
    """Adds ``lines`` and ``chunks``, an array of (n_lines, text).

    The texts of the chunks, joined by line ends, are the whole text.  A null
    text has null chunks, an empty one a single chunk of one empty line.
    """

    def ends(hashes: Column) -> Column:
        def is_end(at: Column) -> Column:
            rolled = F.lit(0).cast("long")
            for back in range(window):
                line = F.try_element_at(hashes, F.when(at > back, at - back))
                rolled += F.coalesce(line, F.lit(0)) * BASE**back
            return (rolled % cut == 0) | (at == F.size(hashes))

        return F.filter(F.sequence(F.lit(1), F.size(hashes)), is_end)

    def chunk(end: Column, start: Column) -> Column:
        body = F.array_join(F.slice("lines", start + 1, end - start), "\n")
        return F.struct((end - start).alias("n_lines"), body.alias("text"))

    # one projection per array: each is used several times by the next one
    return (
        docs.withColumn("lines", F.split(text, "\n", -1))
        .withColumn("_hashes", F.transform("lines", line_hash))
        .withColumn("_ends", ends(F.col("_hashes")))
        .withColumn("_starts", F.concat(F.array(F.lit(0)), "_ends"))
        .withColumn("_starts", F.slice("_starts", 1, F.size("_ends")))
        .withColumn("chunks", F.zip_with("_ends", "_starts", chunk))
        .drop("_hashes", "_ends", "_starts")
    )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.col(id_col).alias("_id"),
        row_key(F.col(id_col), F.col(text_col)).alias("_key"),
    )


def _going(
    keyed: DataFrame,
    text_col: str,
    cut_up: Callable[[DataFrame], DataFrame],
    units: str,
    counts: Callable[[Column], Column],
) -> DataFrame:
    """(_key, _going): entries of the units of a row that have an equal one in an earlier place.

    ``cut_up`` adds the array ``units`` of structs with a text; only those that
    ``counts`` holds for are looked up.
    """
    # units are cut again after each join: the arrays are not what is shuffled
    whole = F.col("doc").getField(text_col)
    texts_only = keyed.select("_key", "_id", whole.alias("_text"))
    # outer: else a filter on the array, written out in full, is put before it
    exploded = cut_up(texts_only).select(
        "_key", "_id", F.posexplode_outer(units).alias("_at", "_unit")
    )
    places = materialize(
        exploded.filter(counts(F.col("_unit"))).select(
            F.xxhash64("_unit.text").alias("_hash"),
            F.octet_length("_unit.text").alias("_size"),
            F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_key"), F.col("_at")).alias("_place"),
        ),
        "line-places",
    )
    same = ["_hash", "_size"]
    first = (
        places.groupBy(*same)
        .agg(F.min("_place").alias("_first"), F.max("_place").alias("_last"))
        # compare places, not counts: a document given twice repeats nothing
        .filter("_first != _last")
        .drop("_last")
    )
    # one row per document, so that each is cut up once
    wanted = first.groupBy(F.col("_first._key").alias("_key")).agg(
        F.collect_set("_first._at").alias("_ats")
    )
    holders = cut_up(texts_only.drop("_id").join(wanted, "_key"))
    texts = (
        holders.select("_ats", F.posexplode_outer(units).alias("_at", "_unit"))
        .filter(F.array_contains("_ats", F.col("_at")))
        .select(
            F.xxhash64("_unit.text").alias("_hash"),
            F.octet_length("_unit.text").alias("_size"),
            F.col("_unit.text").alias("_text"),
        )
        # rows alike give the same text again
        .dropDuplicates(same)
    )
    return (
        places.join(first, same)
        .filter("_place != _first")
        .select(*same, F.col("_place._key").alias("_key"), F.col("_place._at").alias("_at"))
        .distinct()
        .join(texts, same)
        .groupBy("_key")
        .agg(F.collect_set(_entry(F.col("_at"), F.col("_text"))).alias("_going"))
    )


def passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    cut: int = CUT,
) -> DataFrame:
    """Each document with the text that stays.

    Returns one row per row of ``docs``: doc (all its columns), kept (the text
    without repeated chunks of LEAST_LINES lines or more), n_lines and
    removed_lines.  Of equal chunks the one in the smallest id stays (null ids
    come last, then the row's md5, then the place in the text).  A null text
    stays null with 0 lines; a text whose every chunk goes becomes empty.  Rows
    alike in id and text are one document given twice and stay alike.

    The texts are shuffled twice: for the first text of each repeated chunk, and
    to meet the chunks that go.  Only rows with a repeated chunk carry texts
    between these; a chunk in a third of all documents is one row per map task
    in the count and a skewed key of a plain join afterwards.
    """
    def cut_up(df: DataFrame) -> DataFrame:
        return with_chunks(df, "_text", window, cut)

    keyed = _keyed(docs, id_col, text_col)
    going = _going(
        keyed, text_col, cut_up, "chunks", lambda chunk: chunk["n_lines"] >= LEAST_LINES
    )
    entries = F.transform("chunks", lambda c, n: _entry(n, c["text"]))
    # the bytes are compared here: an entry is the place and the whole text
    left = F.array_except(entries, F.coalesce("_going", F.array().cast("array<string>")))
    bodies = F.transform("_left", lambda e: F.substr(e, F.instr(e, ":") + 1))
    kept = F.when(F.col("_going").isNull(), F.col("_text")).otherwise(F.array_join(bodies, "\n"))
    n_lines = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines"))
    n_kept = F.when(F.size("_left") > 0, F.size(F.split("kept", "\n", -1))).otherwise(0)
    joined = keyed.drop("_id").join(going, "_key", "left")
    return (
        cut_up(joined.withColumn("_text", F.col("doc").getField(text_col)))
        .withColumn("_left", left)
        .withColumn("kept", kept)
        .select(
            "doc",
            "kept",
            n_lines.cast("long").alias("n_lines"),
            F.when(F.col("_going").isNull(), 0)
            .otherwise(n_lines - n_kept)
            .cast("long")
            .alias("removed_lines"),
        )
    )


def _entry(at: Column, text: Column) -> Column:
    return F.concat(at.cast("string"), F.lit(":"), text)


def with_windows(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``lines``, ``spans`` and ``windows``: what is looked up for a whole passage.

    A span is (first, last), line numbers from 1: every two neighbouring lines with
    words, with the lines without any between them, then every single line of
    LEAST_WORDS words or more.  ``windows`` has their texts.
    """

    def pair(start: Column, at: Column) -> Column:
        end = F.element_at("_filled", at + 2)
        return F.struct(start.alias("first"), end.alias("last"))

    def body(span: Column) -> Column:
        n_lines = span["last"] - span["first"] + 1
        return F.struct(F.array_join(F.slice("lines", span["first"], n_lines), "\n").alias("text"))

    filled = F.transform("lines", lambda line, at: F.when(line.rlike(WORD), at + 1))
    starts = F.slice("_filled", 1, F.greatest(F.size("_filled") - 1, F.lit(0)))
    long = F.filter("_filled", lambda at: n_words(F.col("lines")[at - 1]) >= LEAST_WORDS)
    alone = F.transform(long, lambda at: F.struct(at.alias("first"), at.alias("last")))
    # one projection per array: each is used several times by the next one
    return (
        docs.withColumn("lines", F.split(text, "\n", -1))
        .withColumn("_filled", F.array_compact(filled))
        .withColumn("spans", F.concat(F.transform(starts, pair), alone))
        .withColumn("windows", F.transform("spans", body))
        .drop("_filled")
    )


def whole_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document without the passages that an earlier place has, whole.

    A line goes if it stands in a window of two lines, or is a line of
    LEAST_WORDS words or more, that is equal byte by byte to one in an earlier
    place; what stands around a passage does not matter.  Places are ordered as
    in ``passages``, whose columns are returned.  The earliest place of every
    line keeps it.  Other single lines that repeat stay.
    """

    def cut_up(df: DataFrame) -> DataFrame:
        return with_windows(df, "_text")

    keyed = _keyed(docs, id_col, text_col)
    going = _going(keyed, text_col, cut_up, "windows", lambda window: window["text"].isNotNull())
    # written, so that the texts shuffled for it are gone when the documents are
    going = materialize(going, "line-going")
    entries = F.transform("windows", lambda w, n: _entry(n, w["text"]))
    # the bytes are compared here, as in passages
    equal = F.array_intersect(entries, F.coalesce("_going", F.array().cast("array<string>")))
    numbers = F.transform(equal, lambda e: F.substring_index(e, ":", 1).cast("int"))
    covered = F.transform(
        "_gone", lambda n: F.sequence(F.col("spans")[n]["first"], F.col("spans")[n]["last"])
    )
    left = F.array_except(F.sequence(F.lit(1), F.size("lines")), F.flatten(covered))
    body = F.array_join(F.transform("_left", lambda at: F.col("lines")[at - 1]), "\n")
    n_lines = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines"))
    joined = keyed.drop("_id").join(going, "_key", "left")
    return (
        cut_up(joined.withColumn("_text", F.col("doc").getField(text_col)))
        .withColumn("_gone", numbers)
        .withColumn("_left", left)
        .select(
            "doc",
            F.when(F.col("_going").isNull(), F.col("_text")).otherwise(body).alias("kept"),
            n_lines.cast("long").alias("n_lines"),
            F.when(F.col("_going").isNull(), 0)
            .otherwise(n_lines - F.size("_left"))
            .cast("long")
            .alias("removed_lines"),
        )
    )


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None
) -> DataFrame:
    """The documents with their columns and what ``whole_passages`` keeps; none is dropped.

    ``length_col`` names a column that holds the length of the text, if any.
    """
    new = {text_col: F.col("kept")}
    if length_col:
        new[length_col] = F.length("kept").cast(docs.schema[length_col].dataType)
    return whole_passages(docs, id_col, text_col).select(
        *[new.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns]
    )
