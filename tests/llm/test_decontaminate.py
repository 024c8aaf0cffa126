"""Matches of benchmark windows against a plain search."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tierframe.llm import decontaminate as de


def plainly(items, words, window):
    """Positions inside windows and the items, by comparing everywhere."""
    hit, found = set(), set()
    for item, own in items:
        size = min(window, len(own))
        for at in range(len(own) - size + 1 if size else 0):
            for start in range(len(words) - size + 1):
                if words[start : start + size] == own[at : at + size]:
                    hit |= set(range(start, start + size))
                    found.add(item)
    return hit, found


RUNS = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=9)


@settings(max_examples=300, deadline=None)
@given(st.lists(RUNS, max_size=5), RUNS, RUNS, st.integers(1, 5))
def test_automaton_finds_what_comparing_finds(items, head, tail, window):
    named = [(str(n % 3), words) for n, words in enumerate(items)]
    words = head + [b"x"] + tail
    ranges, found = de.Automaton(named, window).read(words)
    assert ({p for s, e in ranges for p in range(s, e)}, found) == plainly(named, words, window)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def items_of(spark, texts, ids=None):
    rows = [(ids[n] if ids else n, t) for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, "item_id long, text string")


def judged(docs, items, **named):
    found = de.matches(docs, items, **named)
    return {
        r.doc.doc_id: (r.n_words, [tuple(s) for s in r.spans], r["items"]) for r in found.collect()
    }


def test_words_and_short_items(spark, docs_of):
    docs = docs_of(["One, TWO-three 4é ünü", None, "", "...", "tWo three", "x 日本 y"])
    items = items_of(spark, ["two three", None, "", "!?", "日本", "TWO  three!"], [7, 8, 9, 10, None, 70])
    assert judged(docs, items) == {
        0: (5, [(1, 3)], ["7", "70"]),
        1: (0, [], []),
        2: (0, [], []),
        3: (0, [], []),
        4: (2, [(0, 2)], ["7", "70"]),
        5: (3, [(1, 2)], [""]),
    }


def test_empty_tables(spark, docs_of):
    docs = docs_of(["a b c"])
    assert judged(docs, items_of(spark, [])) == {0: (3, [], [])}
    assert judged(docs.limit(0), items_of(spark, ["a b c"])) == {}


def test_large_benchmarks_take_several_passes(spark, docs_of, monkeypatch):
    draw = random.Random(2)
    word = lambda: draw.choice("abcdefgh")
    items = [[word() for _ in range(draw.choice([0, 2, 5, 60]))] for _ in range(30)]
    texts = [[word() for _ in range(draw.randint(0, 80))] for _ in range(60)]
    texts += [items[k][:9] + ["x"] + items[k][3:40] for k in range(30)]
    docs = docs_of([" ".join(t) for t in texts])
    table = items_of(spark, [" ".join(i) for i in items])
    whole = judged(docs, table, window=4)
    monkeypatch.setattr(de, "PIECE_WORDS", 11)
    monkeypatch.setattr(de, "AUTOMATON_WORDS", 200)
    assert judged(docs, table, window=4) == whole
    named = [(str(n), i) for n, i in enumerate(items)]
    for n, words in enumerate(texts):
        hit, found = plainly(named, words, 4)
        assert {p for s, e in whole[n][1] for p in range(s, e)} == hit
        assert whole[n][2] == sorted(found)


def test_long_text_repeated_rows_and_clashing_names(spark, docs_of):
    long = " ".join(f"w{n}" for n in range(100_000))
    docs = docs_of([long, "a b", "a b"], ids=[1, 2, 2]).withColumn("spans", F.lit("s"))
    docs = docs.withColumn("items", F.lit(1)).withColumn("doc", F.lit(2.0)).withColumn("n_words", F.lit(0))
    found = de.matches(docs, items_of(spark, [" ".join(f"w{n}" for n in range(500, 40_000)), "a b c"]))
    rows = rows_of(found.select("doc.doc_id", "n_words", F.size("items"), "doc.items"))
    assert rows == [(1, 100_000, 1, 1), (2, 2, 0, 1), (2, 2, 0, 1)]
    assert [r.spans for r in found.collect() if r.spans] == [[(500, 40_000)]]


def test_spans_and_covered_documents_go(spark, docs_of):
    item = "the quick brown fox jumps over the lazy dog today again"
    clean = "nothing of the kind here, " * 5
    docs = docs_of([clean + "(The quick, BROWN fox jumps over the lazy dog today again!) end", item, None, "", clean])
    out = de.without_matches(docs, items_of(spark, [item]), length_col="n_chars")
    assert out.columns == docs.columns
    assert rows_of(out, "doc_id") == [
        (0, clean + "(!) end", None, None, len(clean) + 7),
        (2, None, None, None, None),
        (3, "", None, None, 0),
        (4, clean, None, None, len(clean)),
    ]
    kept = de.without_matches(docs, items_of(spark, [item]), longest=12, share=1.0)
    assert sorted(r.text or "" for r in kept.collect()) == sorted(r.text or "" for r in docs.collect())
