"""The Jaccard join against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierframe.llm import ngram_join
from tierframe.llm.components import components


def brute(rows, n=3, num=90, den=100):
    """(id, set size, component) of (id, text) rows by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        width = min(n, len(words))
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= num * max(len(a), len(b)):
                both = len(a & b)
                if both and both * den >= (len(a) + len(b) - both) * num:
                    root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return sorted((key, len(sets[i]), least[find(i)]) for i, (key, _) in enumerate(rows))


def joined(docs):
    return sorted(
        (r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.link_documents(docs).collect()
    )


def test_same_as_all_pairs_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    assert joined(docs) == want
    assert len({w[2] for w in want}) < len(want)


@pytest.mark.parametrize("crowd", [2, 64])
def test_same_as_all_pairs_on_crowds(docs_of, monkeypatch, crowd):
    """Near copies of one text at all distances, chains, and a passage everywhere."""
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    draw = random.Random(7)

    def words(k):
        return ["".join(draw.choice("abcdef") for _ in range(4)) for _ in range(k)]

    def edited(base, k):
        out = list(base)
        for _ in range(k):
            out[draw.randrange(len(out))] = words(1)[0]
        return out

    base, passage = words(120), words(30)
    texts = [edited(base, draw.randint(0, 6)) for _ in range(70)]
    chain = words(100)
    for _ in range(25):
        chain = edited(chain, 1)
        texts.append(chain)
    texts += [passage + words(draw.randint(2, 60)) for _ in range(40)]
    texts += [passage + words(1) for _ in range(15)] + [passage] * 10
    texts = [" ".join(t) for t in texts]
    draw.shuffle(texts)
    assert joined(docs_of(texts)) == brute(list(enumerate(texts)))


def test_edges(docs_of):
    long = " ".join(f"w{n}" for n in range(30_000))
    texts = ["A b", "a  B\n", "a b c", "", None, " \t", long, long + " x", "a b c d", "A B C D", "É f", "é f"]
    docs = docs_of(texts).withColumn("n", F.lit(1)).withColumn("unit", F.lit("x")).withColumn("member", F.lit(1))
    got = joined(docs)
    assert got == brute(list(enumerate(texts)))
    assert [c for _, _, c in got] == [0, 0, 2, 3, 4, 5, 6, 6, 8, 8, 10, 11]
    assert joined(docs.limit(0)) == []
    # a null id links nothing, an id given twice is linked by its texts
    rows = ngram_join.link_documents(docs_of(["a b c d"] * 3 + ["e f g h"] * 2, ids=[None, 4, 3, 4, 9])).collect()
    assert sorted(((r.doc_id, r.component_id) for r in rows), key=str) == [(3, 3), (4, 3), (4, 4), (9, 4), (None, None)]


def test_components_of_path_and_star(spark):
    path = [(n, n + 1) for n in range(60)]
    star = [(1000, 1001 + n) for n in range(200)]
    edges = spark.createDataFrame(path + star + [(5000, 5000), (7, 6)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert len(got) == 61 + 201
    assert len({got[n] for n in range(61)}) == 1
    assert len({got[n] for n in range(1000, 1201)}) == 1
    assert components(edges.limit(0)).collect() == []


def test_sketches_never_exceed_the_difference():
    draw = random.Random(3)
    for bits in (256, 512, 4096):
        for _ in range(50):
            pool = [draw.getrandbits(64) for _ in range(400)]
            a, b = (np.unique(np.array(draw.sample(pool, draw.randint(1, 400)), np.uint64)) for _ in "ab")
            x, y = (ngram_join.parities(s, bits).view(np.uint64) for s in (a, b))
            apart = int(np.bitwise_count(x ^ y).sum())
            assert apart <= len(np.setxor1d(a, b)) and not (ngram_join.parities(a, bits) ^ x.view(np.int64)).any()
            # half as many bits are the two halves put together
            half = ngram_join.parities(a, bits // 2).view(np.uint64)
            assert (half == x[: len(half)] ^ x[len(half) :]).all()


def test_crowded_members_come_last():
    members = np.array([2, 5, 7, 9], np.uint64)
    order = lambda *last: ngram_join.in_order(members, np.array(last, np.uint64)).tolist()
    assert order() == order(1, 6, 2**64 - 1) == [2, 5, 7, 9]
    assert order(2, 6, 7) == [5, 9, 2, 7]
    assert order(2, 5, 7, 9) == [2, 5, 7, 9]
    assert ngram_join.in_order(members[:0], members).tolist() == []
