"""The pipeline's stages against plain versions of what they promise."""

import re

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_ngram_join import brute
from tests.llm.test_texts import counts_of
from tierframe.llm import mixing, ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """The result of every stage, written and read like a run does."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], sf_dir).write.parquet(f"{folder}/{n}")
        out.append(spark.read.parquet(f"{folder}/{n}"))
    return out


def texts_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(stages):
    for before, after in zip(stages, stages[1:-1]):
        assert sorted(after.columns) == sorted(before.columns)
        assert after.count() > 0
    assert stages[-1].columns == ["doc_id", "ids"]


def test_no_text_is_empty(stages):
    for after in stages[1:-1]:
        assert all(WORD.search(r.text) for r in after.collect())
    assert all(r.ids for r in stages[-1].collect())


def test_quality(spark, sf_dir, stages):
    before, after = texts_of(stages[0]), texts_of(stages[1])
    assert all(not counts_of(r.text)[5] and r == before[k] for k, r in after.items())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [k for k, q in labels.items() if q == 1 and not counts_of(before[k].text)[5]]
    assert sum(k in after for k in good) >= 0.9 * len(good)


def test_lines(stages):
    before, after = texts_of(stages[1]), texts_of(stages[2])
    # what is missing was given twice, or has its lines elsewhere
    assert after.keys() <= before.keys() and len(after) > 0.9 * len(before)
    kept = {line for r in after.values() for line in r.text.split("\n") if line.strip()}
    for k in before.keys() - after.keys():
        assert {line for line in before[k].text.split("\n") if line.strip()} <= kept
    for k, r in after.items():
        assert r.n_chars == len(r.text)
        rest = iter(before[k].text.split("\n"))
        assert not r.text or all(any(line == x for x in rest) for line in r.text.split("\n"))


def test_groups(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    assert sorted(texts_of(stages[3])) == sorted({c for _, _, c in brute(rows)})


def test_groups_at_the_values_of_the_stage(spark, sf_dir, docs_of):
    """Edits that 5-word shingles at 0.8 take for copies and 3-word ones at 0.9 do not."""
    base = [f"word{n}" for n in range(500)]
    block = base[:240] + [f"new{n}" for n in range(36)] + base[276:]
    spread = [f"edit{n}" if n % 50 == 25 else w for n, w in enumerate(base)]
    texts = [base, block, spread, base[:440], base[:390], base[100:]]
    rows = [(n, " ".join(t)) for n, t in enumerate(texts)]
    docs = docs_of([t for _, t in rows]).unionByName(
        spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 100)
    )
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted({c for _, _, c in brute(rows, 5, 80, 100)})
    assert want != sorted({c for _, _, c in brute(rows)})
    assert sorted(texts_of(corpus_pipeline.one_of_each_group(spark, docs, sf_dir))) == want


def test_mix_and_tokens(stages):
    sizes = {r.doc_id: r for r in mixing.mix(stages[3]).collect()}
    taken = {r.doc_id: r["count"] for r in stages[4].groupBy("doc_id").count().collect()}
    assert taken == {k: r.copies for k, r in sizes.items() if r.copies}
    library = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path(corpus_pipeline.VOCABULARY))
    texts = texts_of(stages[4])
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    for r in rows:
        assert r.ids == library.encode(texts[r.doc_id].text, add_special_tokens=False).ids


def test_odd_documents_go_through(spark, sf_dir, docs_of):
    long = " ".join(f"word{n}" for n in range(3000))
    texts = [None, "", long, long, "a few plain words that make up one short line of text", long]
    docs = docs_of(texts, ids=[0, 1, 2, 3, None, 2], sources=["a", None, "a", "b", "b", "a"])
    docs = docs.withColumn("kept", F.lit("x")).withColumn("copies", F.lit(3))
    for table in (docs, docs.limit(0)):
        rows = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, sf_dir)
            assert sorted(rows.columns) == sorted(docs.columns)
        assert {r.doc_id for r in corpus_pipeline.to_tokens(spark, rows, sf_dir).collect()} <= {2, None}


def test_representatives_of_rows_alike(docs_of):
    docs = docs_of(["a b c d"] * 3 + ["x y z"] + [None, None], ids=[5, 5, 7, None, None, 9])
    rows = ngram_join.representatives(docs.withColumn("turn", F.lit(1)))
    assert sorted((r.doc_id, r.text) for r in rows.collect() if r.doc_id) == [(5, "a b c d"), (9, None)]
    assert rows.filter("doc_id IS NULL").count() == 2
