"""Operators that SQL expresses: the registered queries, and small cases of their own."""

import os
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from check_oracles import differences
from tests.conftest import SF_DIR, plan_of
from tierframe.llm import host_reputation, line_chunks, mixing, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        duck.execute(f"CREATE VIEW {file.split('.')[0]} AS FROM '{SF_DIR}/{file}'")
    df = queries.QUERIES[name](spark, sf_dir)
    plan = plan_of(df)
    if name not in ("op11_hard_negatives", "op12_decontaminate"):
        assert "Python" not in plan and "Arrow" not in plan
    assert "CartesianProduct" not in plan
    assert differences(df.toPandas(), duck.execute(queries.ORACLES[name]).df()) is None


# --- mixing


def mix_rows(docs, **named):
    return {r.doc_id: r for r in mixing.mix(docs, **named).collect()}


def test_mix_targets_and_budgets(docs_of):
    draw = random.Random(3)
    texts = [" ".join(["w"] * draw.randint(1, 30)) for _ in range(900)]
    # a third of the rows in one source, a null source, a small one that repeats
    sources = ["a" if n % 3 == 0 else "tiny" if n % 90 == 1 else None if n % 3 == 1 else "c" for n in range(900)]
    rows = list(mix_rows(docs_of(texts, sources=sources)).values())
    assert len(rows) == 900
    by = {}
    for r in rows:
        assert r.size == len(texts[r.doc_id].split())
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
        by.setdefault(r.source, []).append(r)
    total = sum(r.size for r in rows)
    # sources by code point, null last: a 5, c 2, tiny 1, null 5
    weight = {"a": 5, "c": 2, "tiny": 1, None: 5}
    size = {s: sum(r.size for r in part) for s, part in by.items()}
    capped, goal = set(), {}
    while True:
        left = 1.5 * total - sum(2 * size[s] for s in capped)
        share = sum(weight[s] for s in size if s not in capped)
        goal = {s: 2 * size[s] if s in capped else left * weight[s] / share for s in size}
        over = {s for s in size if goal[s] > 2 * size[s]}
        if not over - capped:
            break
        capped |= over
    for s, part in by.items():
        assert {r.source_size for r in part} == {size[s]}
        assert part[0].target == pytest.approx(goal[s])
        assert abs(sum(r.taken for r in part) - goal[s]) <= 15
    assert capped


def test_mix_edges(spark, docs_of):
    docs = docs_of(["a b", None, "", "a b", "\u00a0x y"], sources=["s"] * 5, ids=[1, 2, None, 1, 5])
    docs = docs.withColumn("copies", F.lit("x")).withColumn("size", F.lit(9))
    rows = mixing.mix(docs).collect()
    assert sorted(r["size"] for r in rows) == [0, 0, 2, 2, 2]
    assert sorted(mixing.mix(docs).collect(), key=str) == sorted(rows, key=str)
    taken = mixing.mixed_documents(docs)
    assert taken.columns == docs.columns
    assert taken.count() == sum(r.copies for r in rows)
    assert mixing.mix(docs.limit(0)).collect() == []
    assert mixing.mixed_documents(docs.limit(0)).collect() == []


# --- line chunks


def kept_of(docs):
    return {r.doc.doc_id: r for r in line_chunks.passages(docs).collect()}


def test_passage_in_another_place_is_found(docs_of):
    draw = random.Random(4)

    def line():
        return " ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(8))

    passage = [line() for _ in range(12)]
    first = [line() for _ in range(5)] + passage + [line() for _ in range(4)]
    second = [line() for _ in range(2)] + passage + [line() for _ in range(7)]
    alone = [line() for _ in range(9)]
    got = kept_of(docs_of(["\n".join(t) for t in (first, second, alone)]))
    assert got[0].kept == "\n".join(first) and got[2].kept == "\n".join(alone)
    left = got[1].kept.split("\n")
    assert got[1].removed_lines == len(second) - len(left) >= 5
    assert set(second) - set(left) <= set(passage)


def test_single_lines_and_edges_stay(docs_of):
    docs = docs_of(
        ["same\nx", "same", None, "", "a\nb\nc\nd", "a\nb\nc\nd", "a\nb\nc\nd"],
        ids=[0, 1, 2, 3, None, 5, 5],
    ).withColumn("kept", F.lit(1)).withColumn("lines", F.lit(2))
    rows = line_chunks.passages(docs).collect()
    assert len(rows) == 7
    by = {}
    for r in rows:
        by.setdefault(r.doc.doc_id, []).append(r)
    assert by[0][0].kept == "same\nx" and by[1][0].kept == "same"
    assert by[2][0].kept is None and by[2][0].n_lines == 0 and by[3][0].kept == ""
    # the row given twice stays alike; the one with a null id comes last
    assert [r.kept for r in by[5]] == ["a\nb\nc\nd"] * 2
    assert by[None][0].removed_lines >= 2
    changed = line_chunks.without_repeats(docs, length_col="n_chars")
    assert changed.columns == docs.columns and changed.count() == 7
    assert changed.filter("n_chars != length(text)").count() == 0
    assert line_chunks.passages(docs.limit(0)).collect() == []


def test_many_copies_keep_one(docs_of):
    text = "\n".join(f"line {n}" for n in range(40))
    got = kept_of(docs_of([text] * 200 + [text + "\nown"]))
    assert got[0].removed_lines == 0
    assert len({r.kept for n, r in got.items() if n}) <= 2
    assert all(r.removed_lines >= 20 for n, r in got.items() if n)


def test_passages_go_whole(docs_of):
    """Whatever stands around them, and single lines if they are long."""
    a, b, c = "one two", "three", "four five"
    long = " ".join(f"w{n}" for n in range(50))
    texts = [
        "\n".join(["p", a, b, "", c, "q"]),
        "\n".join(["r", a, b, "", c, "s"]),
        "\n".join(["t", a, b]),
        "\n".join(["u", c, long]),
        "\n".join([long, "v", a]),
        "\n".join([long.replace(" w49", ""), "x"]),
        "\n".join([long.replace(" w49", ""), "y"]),
        "x\nx\nx",
        None,
        "",
    ]
    rows = line_chunks.without_repeats(docs_of(texts), length_col="n_chars").collect()
    got = {r.doc_id: r.text for r in rows}
    assert got == {
        **dict(enumerate(texts)), 1: "r\ns", 2: "t", 4: f"v\n{a}", 7: "x",
    }


def test_passages_of_documents_go_whole(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen, want = set(), {}
    for r in sorted(docs.filter("text IS NOT NULL").collect(), key=lambda r: r.doc_id):
        lines, gone = r.text.split("\n"), set()
        filled = [n for n, line in enumerate(lines) if line.strip(" \t\n\x0b\x0c\r")]
        spans = [*zip(filled, filled[1:])]
        spans += [(n, n) for n in filled if len(re.findall(r"[^\x20\x09-\x0D]+", lines[n])) >= 50]
        for start, stop in spans:
            body = "\n".join(lines[start : stop + 1])
            if body in seen:
                gone.update(range(start, stop + 1))
            seen.add(body)
        want[r.doc_id] = "\n".join(line for n, line in enumerate(lines) if n not in gone)
    got = {r.doc_id: r.text for r in line_chunks.without_repeats(docs).collect()}
    assert want.items() <= got.items()


# --- hosts


def test_host_and_path(spark):
    urls = [
        "HTTP://A.Example.NET/en/x?q#f", "x://h", "x://h?q", "x://h#f/p", None, "no scheme",
        "a://b://c/d", "s://ÄB.org/p\nq#r", "://", "s:///p",
    ]
    df = spark.createDataFrame([(n, u) for n, u in enumerate(urls)], "n int, url string")
    host, path = host_reputation.host_and_path(F.col("url"))
    got = [tuple(r) for r in df.select(host, path).collect()]
    assert got == [
        ("a.example.net", "/en/x"), ("h", ""), ("h", ""), ("h", ""), ("", ""), ("", ""),
        ("b:", "//c/d"), ("Äb.org", "/p\nq"), ("", ""), ("", "/p"),
    ]


def test_reputation_blocks_only_proven_hosts(spark):
    pages = [(n, f"s://{h}/x{n}") for n, h in enumerate(
        ["bad.a.org"] * 60 + ["good.a.org"] * 60 + ["new.a.org", "one.a.org", None, "x.net", "fr.org"]
    )]
    pages = [(n, u if h_ok else None) for n, u in pages for h_ok in [u != "s://None/x122"]]
    outcomes = [(u, n % 20 == 0) for n, u in pages[:60]] + [(u, n % 10 > 0) for n, u in pages[60:120]]
    outcomes += [("s://one.a.org/", False), ("s://one.a.org/", None)]
    pages = spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit("x"))
    outcomes = spark.createDataFrame(outcomes, "url string, good boolean")
    got = {r.page_id: r for r in host_reputation.judge(pages, outcomes).collect()}
    assert len(got) == 125
    assert {got[n].verdict for n in range(60)} == {"block"}
    assert {got[n].verdict for n in range(60, 120)} == {"allow"}
    assert got[120].verdict == got[121].verdict == got[122].verdict == "allow"
    assert got[121].n_labelled == 1 and got[122].host == ""
    assert (got[123].verdict, got[123].rule) == ("block", "net/")
    nothing = host_reputation.judge(pages, outcomes.limit(0)).collect()
    assert {r.verdict for r in nothing if r.rule is None} == {"allow"}
    assert host_reputation.judge(pages.limit(0), outcomes).collect() == []


def test_longest_rule_wins(spark):
    rows = spark.createDataFrame(
        [("example.net", "/en/a"), ("a.example.net", "/de/"), ("net", "/"), ("net", ""),
         ("b.example.com", "/de/x"), ("x.org", "/fr/"), ("xorg", "/fr/")],
        "host string, path string",
    )
    rule, verdict = host_reputation.rule_of(F.col("host"), F.col("path"))
    got = [tuple(r) for r in rows.select(rule, verdict).collect()]
    assert got == [
        ("example.net/en/", "allow"), ("net/", "block"), ("net/", "block"), (None, None),
        ("example.com/de/", "block"), ("org/fr/", "allow"), (None, None),
    ]
