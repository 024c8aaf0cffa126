"""SimHash fingerprints of texts and a search for all of them within a Hamming radius.

Terms are the pairs of neighbouring words (the last word stands alone), weighted
by the length of the first one.  The hash of a term votes with that weight on
every bit; a bit is set where the votes for it are more than half.  A long adds
up the votes on two bits at once, 32 bits each, so that a fingerprint is 64
plain sums over the words of a document.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierframe.llm.text import row_key
from tierframe.sources.staging import materialize

# a fingerprint is two longs; their hashes differ by the seed that goes in first
HASHES = 2
BITS = 64 * HASHES
BOTH_LANES = (1 << 32) + 1
LANE = (1 << 32) - 1
# texts that are all but equal, which n_near counts
RADIUS = 3
# near copies: on sf0.1 texts with 5-word Jaccard of 0.8 or more, not equal, differ by
# 3 to 20 bits (median 12)
COPY_RADIUS = 20
# blocks that a fingerprint is cut into: the fewer, the fewer stored ones share a block by
# chance, the more, the fewer flips of a block are looked up
BLOCKS = (5, 6, 7, 8)


def fingerprints(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per key: keys and fp, an array of two longs.

    A text without words, empty or null has the fingerprint of no votes, 0.
    Rows that share a key have to share the text.  Counters hold texts of up to
    2**32 characters, which is more than a string can have.
    """
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    listed = texts.select(*keys, words.alias("_words"))
    pairs = F.arrays_zip(
        F.col("_words").alias("a"), F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(1))).alias("b")
    )
    terms = listed.select(*keys, F.explode_outer(pairs).alias("_t")).select(
        *keys,
        F.coalesce(F.length("_t.a"), F.lit(0)).cast("long").alias("_w"),
        *[
            F.xxhash64(F.lit(seed), "_t.a", "_t.b").alias(f"_h{seed}") for seed in range(HASHES)
        ],
    )

    def votes(seed: int, bit: int) -> Column:
        lanes = F.shiftrightunsigned(f"_h{seed}", bit).bitwiseAND(F.lit(BOTH_LANES))
        return F.sum(lanes * F.col("_w")).alias(f"_v{seed}_{bit}")

    sums = terms.groupBy(*keys).agg(
        F.sum("_w").alias("_all"),
        *[votes(seed, bit) for seed in range(HASHES) for bit in range(32)],
    )

    def bits(seed: int) -> Column:
        parts = []
        for bit in range(32):
            both = F.col(f"_v{seed}_{bit}")
            for lane, at in ((both.bitwiseAND(F.lit(LANE)), bit), (F.shiftrightunsigned(both, 32), bit + 32)):
                value = (1 << at) - ((1 << 64) if at == 63 else 0)
                parts.append(F.when(lane * 2 > F.col("_all"), F.lit(value).cast("long")).otherwise(F.lit(0).cast("long")))
        # balanced, so that the expression stays shallow
        while len(parts) > 1:
            parts = [reduce(lambda a, b: a.bitwiseOR(b), parts[i : i + 4]) for i in range(0, len(parts), 4)]
        return parts[0]

    return sums.select(*keys, F.array(*[bits(seed) for seed in range(HASHES)]).alias("fp"))


def as_hex(fp: Column) -> Column:
    return F.concat(*[F.lower(F.lpad(F.hex(fp[n]), 16, "0")) for n in range(HASHES)])


def distance(a: Column, b: Column) -> Column:
    """Bits in which two fingerprints differ."""
    return reduce(add, [F.bit_count(a[n].bitwiseXOR(b[n])) for n in range(HASHES)])


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, about 0.5 for unrelated ones."""
    return 1 - distance(a, b) / F.lit(float(BITS))


def _parts(radius: int, n_blocks: int) -> list[int]:
    """The part of the radius that each block gets, -1 where it is not looked up."""
    part, more = divmod(radius, n_blocks)
    return [part if t <= more else part - 1 for t in range(n_blocks)]


def _widths(n_blocks: int) -> list[int]:
    width, more = divmod(BITS, n_blocks)
    return [width + (t < more) for t in range(n_blocks)]


def best_blocks(radius: int, expected: int) -> int:
    """The number of blocks with the least flips and candidates for a query.

    A query is put in once for each flip and meets the stored fingerprints, about
    ``expected``, that share the block by chance.  Any number gives the same hits.
    """

    def work(n_blocks: int) -> float:
        return sum(
            sum(comb(width, k) for k in range(part + 1)) * (1 + expected / 2**width)
            for width, part in zip(_widths(n_blocks), _parts(radius, n_blocks))
        )

    return min(BLOCKS, key=work)


def near_pairs(stored: DataFrame, queries: DataFrame, radius: int, expected: int) -> DataFrame:
    """(fp, near_fp, apart): all stored fingerprints within ``radius`` bits of each query.

    Both sides have a column fp and are collapsed to distinct fingerprints first;
    ``expected`` is about the number of stored ones, and decides the number of blocks.
    The bits are cut into blocks; of the radius each gets an equal part, the
    first ones of what is left over one bit more, and the blocks of no part are not
    looked up.  If two fingerprints differed by more than (its part of the radius)
    in every block, they would differ by more than the radius, so all hits agree in
    one block but for that many bits.  The queries, few against the stored ones,
    are put in with every way to flip these.  A pair counts in the first such block.
    """
    n_blocks = best_blocks(radius, expected)
    parts, widths = _parts(radius, n_blocks), _widths(n_blocks)
    used = [t for t in range(n_blocks) if parts[t] >= 0]

    def block(fp: Column, t: int) -> Column:
        n, at = divmod(sum(widths[:t]), 64)
        moved = F.shiftrightunsigned(fp[n], at)
        if at + widths[t] > 64:
            moved = moved.bitwiseOR(F.shiftleft(fp[n + 1], 64 - at))
        return moved.bitwiseAND(F.lit((1 << widths[t]) - 1).cast("long"))

    def flips(t: int) -> Column:
        """Ways to flip at most the part of a block, as a literal array."""
        bits = [1 << bit for bit in range(widths[t])]
        masks = [sum(some) for k in range(parts[t] + 1) for some in combinations(bits, k)]
        return F.split(F.lit(",".join(map(str, masks))), ",").cast("array<long>")

    def led(value: Column, t: Column) -> Column:
        return (value * n_blocks + t).alias("led")

    def tables(df: DataFrame, name: str) -> DataFrame:
        values = F.array(*[F.struct(F.lit(t).alias("t"), block(F.col("fp"), t).alias("v")) for t in used])
        return df.select("fp").distinct().select(F.col("fp").alias(name), F.inline(values))

    ways = reduce(lambda rest, t: F.when(F.col("t") == t, flips(t)).otherwise(rest), used[1:], flips(used[0]))
    left = tables(queries, "fp").select("fp", "t", "v", F.explode(ways).alias("flip"))
    left = left.select("fp", "t", led(F.col("v").bitwiseXOR(F.col("flip")), F.col("t")))
    right = tables(stored, "near_fp").select("near_fp", led(F.col("v"), F.col("t")))
    q, s = F.col("fp"), F.col("near_fp")
    first = F.coalesce(
        *[
            F.when(F.bit_count(block(q, t).bitwiseXOR(block(s, t))) <= parts[t], F.lit(t))
            for t in used
        ]
    )
    # not broadcast: the size of the queries is guessed without their flips
    return (
        left.join(right.hint("merge"), "led")
        .filter((distance(q, s) <= radius) & (first == F.col("t")))
        .select("fp", "near_fp", distance(q, s).cast("int").alias("apart"))
    )


def near_counts(
    stored: DataFrame, queries: DataFrame, radius: int = RADIUS, expected: int = 0
) -> DataFrame:
    """How many stored rows lie within ``radius`` bits of each distinct query.

    ``stored`` has fp and copies (how many rows it stands for), ``queries`` has
    fp; returns fp and n_near for every distinct fp of ``queries``, 0 where there
    is none.  ``expected``: about how many different fp are stored.
    """
    copies = stored.groupBy(F.col("fp").alias("near_fp")).agg(F.sum("copies").alias("n"))
    hits = (
        near_pairs(stored, queries, radius, expected).join(copies, "near_fp")
        .groupBy("fp").agg(F.sum("n").alias("n_near"))
    )
    return (
        queries.select("fp")
        .distinct()
        .join(hits, "fp", "left")
        .select("fp", F.coalesce("n_near", F.lit(0)).alias("n_near"))
    )


def fingerprint_classes(stored: DataFrame) -> DataFrame:
    """(fp, class_id, n): each fingerprint, the smallest doc_id of it, and its rows."""
    return stored.groupBy("fp").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("n"))


def near_classes(
    classes: DataFrame, queries: DataFrame, radius: int, copy_radius: int, expected: int
) -> DataFrame:
    """fp, n_near, n_copies and near_classes of each distinct query.

    ``classes`` as ``fingerprint_classes`` returns them.  n_near counts rows within
    ``radius``, n_copies those within ``copy_radius``, the larger one; near_classes has
    (apart, class_id, n) of every different fingerprint within ``copy_radius`` in this
    order.  Texts that are alike share a fingerprint, so a crowd of them is one entry.
    """
    hits = near_pairs(classes, queries, copy_radius, expected)
    named = hits.join(classes.withColumnRenamed("fp", "near_fp"), "near_fp")
    return named.groupBy("fp").agg(
        F.coalesce(F.sum(F.when(F.col("apart") <= radius, F.col("n"))), F.lit(0)).alias("n_near"),
        F.sum("n").alias("n_copies"),
        F.sort_array(F.collect_list(F.struct("apart", "class_id", "n"))).alias("near_classes"),
    )


def successors(rows: DataFrame, order: list[Column], key: str) -> DataFrame:
    """(key, next_key): the row after each one in the order, after the last the first.

    The rows are range-partitioned and written once, as the bounds are sampled;
    windows run inside a range, and the first row of each range, one per
    partition, goes to the one before.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(
        rows.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    placed = ranged.withColumn("_next", F.lead(key).over(inside)).withColumn(
        "_first", F.row_number().over(inside) == 1
    )
    firsts = ranged.withColumn("_n", F.row_number().over(inside)).filter("_n = 1")
    # one row per range
    by_range = Window.orderBy("_range")
    wrap = F.first(key).over(by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select("_range", F.coalesce(F.lead(key).over(by_range), wrap).alias("_after"))
    return placed.join(firsts, "_range").select(
        *rows.columns, F.coalesce("_next", "_after").alias(f"next_{key}")
    )


def edits_and_neighbours(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
    copy_radius: int = COPY_RADIUS,
) -> DataFrame:
    """Fingerprint of each text, of an edited version, and of the next document.

    The edited text has its last half replaced by as much of the start of the
    next document, in descending id.  Returns one row per row of ``docs``: doc_id,
    n_chars, edited_sha256, fingerprint and edited_fingerprint (hex),
    near_edited, near_next (likeness, 0 to 1), class_id (the smallest doc_id of its
    fingerprint, null if all are null), and for ids divisible by 100 n_near and n_copies,
    the number of rows within ``radius`` and ``copy_radius`` bits, and near_classes,
    (apart, class_id, n) of every fingerprint within ``copy_radius`` and its rows; the
    document's own is included in each.  They are null for the others, which are not
    searched for.

    A null text is empty.  Rows alike in id and text are one document here and
    get equal results; null ids come last.  The texts are shuffled once and
    half of each once more, to the document it is cut into.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(
        F.col(id_col).alias("doc_id"),
        F.unhex(row_key(F.col(id_col), F.col(text_col))).alias("key"),
        text.alias("text"),
    )
    rows = named.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"),
        F.max(F.length("text").cast("long")).alias("n_chars"),
        F.count(F.lit(1)).alias("copies"),
    )
    order = [F.col("doc_id").desc_nulls_last(), F.col("key")]
    follow = materialize(successors(rows, order, "key"), "successors")
    printed = materialize(
        fingerprints(_both_texts(named, follow), ["key", "edited", "sha"], "text"), "fingerprints"
    )
    own = printed.filter("edited = 0").select("key", "fp")
    changed = printed.filter("edited = 1").select("key", "sha", F.col("fp").alias("edited_fp"))
    after = own.select(F.col("key").alias("next_key"), F.col("fp").alias("next_fp"))
    joined = follow.join(own, "key").join(changed, "key").join(after, "next_key")
    asked = F.col("doc_id") % 100 == 0
    classes = materialize(fingerprint_classes(joined.select("fp", "copies", "doc_id")), "classes")
    found = near_classes(
        classes, joined.filter(asked).select("fp"), radius, copy_radius, classes.count()
    )
    # by key: rows that are not asked for have none in common
    near = joined.filter(asked).select("key", "fp").join(found, "fp").drop("fp")
    return (
        joined.join(classes.select("fp", "class_id"), "fp")
        .join(near, "key", "left")
        .select(
            "doc_id",
            "n_chars",
            F.lower(F.hex("sha")).alias("edited_sha256"),
            as_hex(F.col("fp")).alias("fingerprint"),
            as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
            likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
            likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
            "class_id",
            "n_near",
            "n_copies",
            "near_classes",
            F.explode(F.sequence(F.lit(1), "copies")).alias("_copy"),
        )
        .drop("_copy")
    )


def _both_texts(named: DataFrame, follow: DataFrame) -> DataFrame:
    """key, edited (0 or 1), sha (of the edited one) and text, partitioned by key."""
    texts = named.dropDuplicates(["key"]).select("key", "text")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    heads = follow.select("next_key", F.col("key").alias("_of"), half.alias("_half")).join(
        texts.withColumnRenamed("key", "next_key"), "next_key"
    )
    heads = heads.select(
        F.col("_of").alias("key"), "_half", F.substr("text", F.lit(1), F.col("_half")).alias("_head")
    )
    start = F.substr("text", F.lit(1), F.length("text") - F.col("_half"))
    edited = texts.join(heads, "key").select("key", "text", F.concat(start, "_head").alias("_edited"))
    versions = F.array(
        F.struct(F.lit(0).alias("edited"), F.lit(None).cast("binary").alias("sha"), F.col("text").alias("text")),
        F.struct(
            F.lit(1).alias("edited"),
            F.unhex(F.sha2("_edited", 256)).alias("sha"),
            F.col("_edited").alias("text"),
        ),
    )
    return edited.select("key", F.inline(versions))
