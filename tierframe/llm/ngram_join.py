"""Jaccard join on word n-grams, by a grouped prefix filter.

The n-grams of a document are a set of 64-bit hashes in a fixed order.  Two sets
above the threshold share one of their first few members, the prefix.  Documents of
equal sets are one unit, units of equal prefix and size one group; groups that share
a prefix member are paired behind tests of their sizes, of the member's positions
and of parity sketches, the pairs expanded to their units and verified on whole sets.

Members that many groups share, such as those of a common passage, come last in the
order: that keeps them out of the prefixes of all documents with enough others.
Where near copies leave many groups at one member all the same, a few pivots of the
member are verified first and what is linked becomes one, since only connections are
asked for; the exact join then pairs only what is still apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierframe.llm.components import components
from tierframe.llm.text import fresh, ragged, row_key
from tierframe.sources.staging import discard, materialize

N = 3
# Jaccard similarity of at least NUM / DEN
NUM, DEN = 90, 100
# a member that more units or groups share than this is a crowd
CROWD = 32
# lengths of the prefix in which crowded members are looked for
REACH = 2
# pivots of a crowded member that its groups are verified against
PIVOTS = 3
# crowded members, of eight bytes each, that come last in the order: the most
# frequent ones.  Any order is right; this bounds what is broadcast
FEW = 200_000
# bits of the parity sketch of a unit, and of that of a group
SKETCH, FOLDED = 512, 256


def shingles(text: bytes, n: int = N) -> np.ndarray:
    """Ascending distinct hashes of the n-grams of words, A-Z as a-z.

    With fewer than n words all of them are one n-gram; without words there is none.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(n, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for at in range(width):
        out ^= out >> np.uint64(31)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out += hashes[at : at + len(out)]
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def prefix_length(n: int, num: int = NUM, den: int = DEN) -> int:
    return n - -(-n * num // den) + 1


def in_order(members: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Ascending members with those of ``last`` (ascending too) behind all others."""
    if not len(last) or not len(members):
        return members
    at = np.searchsorted(last, members)
    crowded = last[np.minimum(at, len(last) - 1)] == members
    return np.concatenate([members[~crowded], members[crowded]]) if crowded.any() else members


def parities(members: np.ndarray, bits: int) -> np.ndarray:
    """Longs whose bits are the parities of the members' buckets.

    Sets that differ in d members differ in d bits at most.  ``bits`` is a power of
    two; half as many come from the exclusive or of the two halves.
    """
    bucket = (members * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)).astype(np.int64) % bits
    odd = np.bincount(bucket, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _digest(values: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(values.tobytes())


def _lists(arrays: list[np.ndarray], of: pa.DataType) -> pa.Array:
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return ragged(flat.view(np.int64), np.array([len(a) for a in arrays], np.int64), of)


def heads(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """unit and the first members of each set, REACH prefixes of them."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for t in batch.column("text").to_pylist() if len(s := shingles(t, n))]
            first = [s[: REACH * prefix_length(len(s), num, den)] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(_digest, sets), pa.binary()), _lists(first, pa.int64())], ["unit", "heads"]
            )

    return docs.select("text").mapInArrow(listed, "unit binary, heads array<long>")


def crowded_members(docs: DataFrame, n: int, num: int, den: int) -> np.ndarray:
    """Members that more than CROWD units have among their heads, the FEW most frequent ones."""
    units = heads(docs, n, num, den).groupBy("unit").agg(F.first("heads").alias("heads"))
    counts = units.select(F.explode("heads").alias("member")).groupBy("member").count()
    most = counts.filter(F.col("count") > CROWD).orderBy(F.desc("count"), "member").limit(FEW)
    rows = most.select("member").toPandas()["member"].to_numpy(np.int64)
    return np.sort(rows.view(np.uint64))


def signatures(docs: DataFrame, last: np.ndarray, n: int, num: int, den: int) -> DataFrame:
    """Per row: doc_id, unit (digest of the set), n, mates (digest of prefix and size),
    prefix, sketch (SKETCH bits) and wide (as many bits as members or more, to a power
    of two).  Rows without n-grams have n 0 and no digests."""
    cast = docs.sparkSession.sparkContext.broadcast(last)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, sizes, mates, prefixes, sketches, wides = [], [], [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, n)
                size = len(found)
                head = in_order(found, cast.value)[: prefix_length(size, num, den) if size else 0]
                wide = parities(found, max(SKETCH, 1 << size.bit_length()))
                units.append(_digest(found) if size else None)
                mates.append(_digest(np.append(head, np.uint64(size))) if size else None)
                sizes.append(size)
                prefixes.append(head)
                wides.append(wide)
                sketches.append(np.bitwise_xor.reduce(wide.reshape(-1, SKETCH // 64), axis=0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(units, pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.array(mates, pa.binary()),
                    _lists(prefixes, pa.int64()),
                    _lists(sketches, pa.int64()),
                    _lists(wides, pa.int64()),
                ],
                ["doc_id", "unit", "n", "mates", "prefix", "sketch", "wide"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = "prefix array<long>, sketch array<long>, wide array<long>"
    return docs.mapInArrow(signed, f"doc_id {kind}, unit binary, n int, mates binary, {lists}")


def member_lists(docs: DataFrame, n: int) -> DataFrame:
    """unit and members: the whole set of each row."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for t in batch.column("text").to_pylist() if len(s := shingles(t, n))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(_digest, sets), pa.binary()), _lists(sets, pa.int64())], ["unit", "members"]
            )

    return docs.select("text").mapInArrow(listed, "unit binary, members array<long>")


def few(rows: DataFrame) -> DataFrame:
    """Broadcast if there are at most FEW; a larger table is shuffled."""
    return F.broadcast(rows) if rows.limit(FEW + 1).count() <= FEW else rows


def _differing(a: Column, b: Column, longs: int) -> Column:
    return reduce(add, [F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(longs)])


def _differing_wide(a: Column, b: Column) -> Column:
    """Of sketches of which one may be twice as long."""

    def half(x: Column, other: Column) -> Column:
        n = F.size(other)
        xor = lambda p, q: p.bitwiseXOR(q)
        folded = F.zip_with(F.slice(x, F.lit(1), n), F.slice(x, n + 1, n), xor)
        return F.when(F.size(x) > n, folded).otherwise(x)

    bits = F.zip_with(half(a, b), half(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(bits, F.lit(0), lambda total, k: total + k)


class _Join:
    def __init__(self, docs: DataFrame, n: int, num: int, den: int):
        self.docs, self.n, self.num, self.den = docs, n, num, den

    def sizes_fit(self, a: Column, b: Column) -> Column:
        a, b = a.cast("long"), b.cast("long")
        return (a * self.den >= b * self.num) & (b * self.den >= a * self.num)

    def within(self, a: Column, b: Column, apart: Column) -> Column:
        """Whether sets of these sizes that differ in no fewer members may be similar enough."""
        return apart * (self.num + self.den) <= (a.cast("long") + b.cast("long")) * (self.den - self.num)

    def placed(self, a: Column, b: Column, i: Column, j: Column) -> Column:
        """Whether sets with a common member at places i and j may be similar enough."""
        most = F.least(i, j) + F.least(a - i, b - j)
        return most.cast("long") * (self.num + self.den) >= (a.cast("long") + b.cast("long")) * self.num

    def run(self) -> DataFrame:
        """doc_id, n, unit, label of every row."""
        last = crowded_members(self.docs, self.n, self.num, self.den)
        signed = materialize(signatures(self.docs, last, self.n, self.num, self.den), "signatures")
        units = signed.filter("n > 0 AND doc_id IS NOT NULL").groupBy("unit").agg(
            F.min("doc_id").alias("first"),
            *[F.first(c).alias(c) for c in ("n", "mates", "prefix", "sketch", "wide")],
        )
        units = materialize(units, "units")
        leads = units.groupBy("mates").agg(
            F.min(F.struct("first", "unit"))["unit"].alias("lead"), F.count(F.lit(1)).alias("_units")
        )
        slim = units.select("unit", "mates").join(leads, "mates").select("unit", "lead", "_units")
        slim = materialize(slim, "leads")

        # groups that share a member of their prefixes with another group
        prefixes = units.select("unit", "prefix").join(slim.filter("unit = lead").select("unit"), "unit")
        of_groups = prefixes.select(F.col("unit").alias("lead"), F.posexplode("prefix").alias("pos", "member"))
        shared = of_groups.groupBy("member").agg(F.count(F.lit(1)).alias("_groups")).filter("_groups > 1")
        postings = materialize(of_groups.join(shared, "member"), "postings")
        live = postings.select("lead").distinct().withColumn("_live", F.lit(True))
        wanted = slim.join(live, "lead", "left").filter("_live OR _units > 1").select("unit", "lead")
        facts = units.select("unit", "first", "n", "sketch", "wide").join(wanted, "unit")
        active = materialize(facts, "active")
        discard(units, slim)

        labels = materialize(active.select("unit", F.col("unit").alias("comp")), "labels")
        labels = self.settled(labels, active, self.proposals(active, postings), (1, None))
        labels = self.settled(labels, active, self.rest(active, postings, labels), (1, 8, None))
        discard(active, postings)
        return signed.select("doc_id", "n", "unit").join(
            labels.select("unit", F.col("comp").alias("label")), "unit", "left"
        )

    def near(self, pairs: DataFrame, active: DataFrame) -> DataFrame:
        """Of pairs (a, b) of units those that may be linked by size and sketches, with
        apart, the members that they differ in at least."""
        facts = active.select("unit", "n", "sketch", "wide")
        a, b = (facts.select(F.col("unit").alias(s), F.struct("n", "sketch", "wide").alias(f"_{s}")) for s in "ab")
        both = pairs.join(a, "a").join(b, "b")
        n = F.col("_a.n"), F.col("_b.n")
        narrow = _differing(F.col("_a.sketch"), F.col("_b.sketch"), SKETCH // 64)
        close = both.filter(self.sizes_fit(*n) & self.within(*n, narrow))
        wide = _differing_wide(F.col("_a.wide"), F.col("_b.wide"))
        return close.withColumn("apart", wide).filter(self.within(*n, F.col("apart"))).select("a", "b", "apart")

    def settled(
        self, labels: DataFrame, active: DataFrame, pairs: DataFrame, turns: tuple[int | None, ...]
    ) -> DataFrame:
        """labels (unit, comp) after the pairs (a, b) that prove similar.

        In each turn so many of the nearest pairs of a unit are verified, in the last
        one all; pairs that are connected by then need no look.
        """
        left = materialize(self.near(pairs.distinct(), active), "near")
        for turn in turns:
            if left.isEmpty():
                break
            nearest = Window.partitionBy("a").orderBy("apart", "b")
            chosen = left.select("a", "b")
            if turn:
                chosen = left.withColumn("_turn", F.row_number().over(nearest)).filter(F.col("_turn") <= turn)
            tried = materialize(chosen.select("a", "b"), "tried")
            ends = tried.select(F.explode(F.array("a", "b")).alias("unit")).distinct()
            sets = self.sets_of(active.join(ends, "unit").select("unit", "first"))
            links = materialize(self.linked(tried, sets), "links")
            discard(sets)
            if not links.isEmpty():
                labels = self.relabelled(labels, links)
            # a pair that was looked at is a link or none
            rest = left.join(tried, ["a", "b"], "left_anti")
            for end in ("a", "b"):
                comps = labels.select(F.col("unit").alias(end), F.col("comp").alias(f"_{end}"))
                rest = rest.join(comps, end)
            rest = materialize(rest.filter("_a != _b").select("a", "b", "apart"), "near")
            discard(left, tried, links)
            left = rest
        discard(left)
        return labels

    def sets_of(self, units: DataFrame) -> DataFrame:
        """Members (unit, members) of some units (unit, first), from their texts."""
        units = materialize(units, "ends")
        ids = few(units.select(F.col("first").alias("doc_id")).distinct())
        made = member_lists(self.docs.join(ids, "doc_id", "left_semi"), self.n)
        # an id that repeats brings other sets along, or the same one again
        wanted = made.join(few(units.select("unit").distinct()), "unit", "left_semi")
        sets = materialize(wanted.dropDuplicates(["unit"]), "sets")
        discard(units)
        return sets

    def linked(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (a, b) of units whose whole sets are similar enough."""
        first = sets.select(F.col("unit").alias("a"), F.col("members").alias("_x"))
        second = sets.select(F.col("unit").alias("b"), F.col("members").alias("_y"))
        both = F.size(F.array_intersect("_x", "_y")).cast("long")
        either = F.size("_x") + F.size("_y") - both
        return (
            pairs.join(first, "a").join(second, "b")
            .filter(both * self.den >= either * self.num).select("a", "b")
        )

    def relabelled(self, labels: DataFrame, links: DataFrame) -> DataFrame:
        """labels (unit, comp) after the links; linked components become one."""
        ends = links
        for end in ("a", "b"):
            own = labels.select(F.col("unit").alias(end), F.col("comp").alias(f"_{end}"))
            ends = ends.join(own, end).drop(end).withColumnRenamed(f"_{end}", end)
        roots = components(ends)
        out = labels.join(roots.withColumnRenamed("node", "comp"), "comp", "left").select("unit", F.coalesce("root", "comp").alias("comp"))
        out = materialize(out, "labels")
        discard(labels, roots)
        return out

    def proposals(self, active: DataFrame, postings: DataFrame) -> DataFrame:
        """Units with the lead of their group, and groups of crowded members with pivots.

        Pivots are the groups of the smallest hashes, so there is a pair per posting
        and pivot at most.
        """
        inside = active.filter("unit != lead").select(F.col("unit").alias("a"), F.col("lead").alias("b"))
        crowds = postings.filter(F.col("_groups") > CROWD)
        pivots = crowds.groupBy("member").agg(
            F.array(
                *[F.min(F.struct(F.xxhash64(F.lit(t), "lead"), "lead"))["lead"] for t in range(PIVOTS)]
            ).alias("_pivots")
        )
        pairs = crowds.join(pivots, "member").select(
            F.col("lead").alias("a"), F.explode("_pivots").alias("b")
        )
        return inside.unionByName(pairs.filter("a != b"))

    def rest(self, active: DataFrame, postings: DataFrame, labels: DataFrame) -> DataFrame:
        """Every pair of units in different components that may be linked, by prefixes."""
        longs = range(FOLDED // 64)
        bits = [F.col("sketch")[i].bitwiseXOR(F.col("sketch")[i + FOLDED // 64]) for i in longs]
        known = active.select("unit", "lead", "n", *[x.alias(f"_{i}") for i, x in enumerate(bits)])
        # a group has the bits that all of its units have, and those that any has
        groups = known.join(labels, "unit").groupBy("lead").agg(
            F.first("n").alias("n"),
            F.min(F.xxhash64("comp")).alias("low"),
            F.max(F.xxhash64("comp")).alias("high"),
            *[F.bit_and(f"_{i}").alias(f"all{i}") for i in longs],
            *[F.bit_or(f"_{i}").alias(f"any{i}") for i in longs],
        )
        groups = materialize(groups, "groups")
        mixed = postings.join(groups.select("lead", "low", "high"), "lead").groupBy("member").agg(
            F.min("low").alias("_low"), F.max("high").alias("_high")
        ).filter("_low != _high").select("member")
        open_ = materialize(
            postings.drop("_groups").join(mixed, "member").join(groups, "lead"), "open"
        )
        one = lambda side, c: F.col(f"{side}.{c}")
        surely = reduce(
            add,
            [
                F.bit_count(
                    one(x, f"all{i}").bitwiseAND(F.bitwise_not(one(y, f"any{i}")))
                )
                for i in longs
                for x, y in (("a", "b"), ("b", "a"))
            ],
        )
        n = one("a", "n"), one("b", "n")
        together = (
            (one("a", "low") == one("a", "high"))
            & (one("b", "low") == one("b", "high"))
            & (one("a", "low") == one("b", "low"))
        )
        met = (
            (one("a", "member") == one("b", "member"))
            & (one("a", "lead") < one("b", "lead"))
            & ~together
            & self.sizes_fit(*n)
            & self.placed(*n, one("a", "pos"), one("b", "pos"))
            & self.within(*n, surely)
        )
        pairs = open_.alias("a").join(open_.alias("b"), met).select(
            one("a", "lead").alias("_a"), one("b", "lead").alias("_b")
        )
        pairs = materialize(pairs.distinct(), "group_pairs")
        discard(open_)
        # units are tested where they meet: a group's bits say little if it is large
        of_units = active.select("unit", "lead", "n", "sketch").join(labels, "unit")
        a, b = (of_units.select(*[F.col(c).alias(f"{s}_{c}") for c in of_units.columns]) for s in "ab")
        sizes = F.col("a_n"), F.col("b_n")
        apart = _differing(F.col("a_sketch"), F.col("b_sketch"), SKETCH // 64)
        near = (F.col("a_comp") != F.col("b_comp")) & self.within(*sizes, apart)
        split = groups.filter("low != high").select(F.col("lead").alias("a_lead"))
        inside = a.join(split, "a_lead", "left_semi").join(
            b, (F.col("a_lead") == F.col("b_lead")) & (F.col("a_unit") < F.col("b_unit")) & near
        )
        across = pairs.join(a, F.col("_a") == F.col("a_lead")).join(
            b, (F.col("_b") == F.col("b_lead")) & near
        )
        found = reduce(
            DataFrame.unionByName,
            [p.select(F.col("a_unit").alias("a"), F.col("b_unit").alias("b")) for p in (across, inside)],
        )
        found = materialize(found, "pairs")
        discard(groups, pairs)
        return found


def link_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = N,
    num: int = NUM,
    den: int = DEN,
) -> DataFrame:
    """Components of documents whose n-gram sets have a Jaccard of num / den or more.

    Returns one row per row of ``docs``: doc_id, n_shingles (size of the set) and
    component_id, the smallest id that links reach, itself included.  Null and
    empty texts have no n-grams and are linked with nothing.  Rows with a null
    id are counted but not linked and have a null component.  Rows that repeat
    an id are linked by their texts, not by the id: each has the component of its
    own text.  An empty table gives no rows.
    """
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    rows = materialize(_Join(texts, n, num, den).run(), "linked")
    # units without a label are alone with their copies
    own = rows.select("doc_id", "n", F.coalesce("label", "unit").alias("label"))
    least = own.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("_least"))
    return own.join(least, "label", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("_least", "doc_id")).alias("component_id"),
    )


def representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int
) -> DataFrame:
    """One document of each component, the one of the smallest id, columns unchanged.

    Documents without n-grams are a component each.  Rows of a null id are not
    compared and stay.  Of rows alike in id and text one stays; an id given to
    several texts stays with all of them if it is the smallest for any.
    """
    linked = link_documents(docs, id_col, text_col, **options)
    least = linked.filter("component_id = doc_id").select(F.col("doc_id").alias(id_col)).distinct()
    # same partitioning as the join
    alike = Window.partitionBy(id_col, row_key(F.col(id_col), F.col(text_col))).orderBy(F.lit(0))
    turn = fresh(docs, "turn")
    kept = (
        docs.join(least, id_col, "left_semi").withColumn(turn, F.row_number().over(alike))
        .filter(F.col(turn) == 1)
    )
    return kept.select(docs.columns).unionByName(docs.filter(F.col(id_col).isNull()))
