"""Fingerprints, languages, quality and personal data against brute force and held-out rows."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tierframe.llm import language, personal_data, quality, queries, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- fingerprints


def chained(seed, a, b):
    """Hash of several columns as Spark chains it: each value seeds the next."""
    h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
    h = xxhash.xxh64_intdigest(a.encode(), h)
    return h if b is None else xxhash.xxh64_intdigest(b.encode(), h)


def fingerprint(text):
    words = WORD.findall(text)
    out = ""
    for seed in range(2):
        votes = [0] * 64
        for n, a in enumerate(words):
            h = chained(seed, a, words[n + 1] if n + 1 < len(words) else None)
            for bit in range(64):
                votes[bit] += len(a) if h >> bit & 1 else -len(a)
        out += f"{sum((v > 0) << bit for bit, v in enumerate(votes)):016x}"
    return out


def likeness(a, b):
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128


def test_fingerprints_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    df = queries.op2_simhash(spark, sf_dir)
    assert "Python" not in plan_of(df) and "Arrow" not in plan_of(df)
    got = {r.doc_id: r for r in df.collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    order = sorted(texts, reverse=True)
    prints = {k: fingerprint(t) for k, t in texts.items()}
    assert len(got) == len(texts)
    for n, key in enumerate(order):
        text, after = texts[key], order[(n + 1) % len(order)]
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[after][:half]
        row = got[key]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == prints[key]
        assert row.edited_fingerprint == fingerprint(edited)
        assert row.near_edited == pytest.approx(likeness(prints[key], row.edited_fingerprint))
        assert row.near_next == pytest.approx(likeness(prints[key], prints[after]))
        near = sum(likeness(prints[key], p) >= 1 - 3 / 128 for p in prints.values())
        assert row.n_near == (near if key % 100 == 0 else None)
    nearer = sum(r.near_edited > r.near_next for r in got.values())
    assert nearer > 0.85 * len(got)


def test_fingerprint_edges(docs_of):
    docs = docs_of(
        ["", None, "one", "one", " \n", "a b", "a b"], ids=[0, 100, 2, None, 4, 200, 200]
    ).withColumn("key", F.lit(1)).withColumn("fp", F.lit(2))
    rows = simhash.edits_and_neighbours(docs).collect()
    assert len(rows) == 7
    by = {r.doc_id: r for r in rows}
    assert by[0].fingerprint == by[100].fingerprint == "0" * 32
    assert by[2].fingerprint == by[None].fingerprint == fingerprint("one")
    # " \n" has no words either; both rows of id 200 count
    assert by[0].n_near == by[100].n_near == 3 and by[200].n_near == 2
    # 4 comes after 100 in descending id, 0 after 2, then null, then 200 again
    assert by[None].edited_sha256 == hashlib.sha256(b"one"[:2] + b"a").hexdigest()
    assert simhash.edits_and_neighbours(docs.limit(0)).collect() == []
    alone = simhash.edits_and_neighbours(docs_of(["abcd"])).collect()[0]
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and alone.near_next == 1


def test_block_tables_find_all(spark):
    draw = random.Random(6)
    base = [[draw.getrandbits(64) for _ in range(2)] for _ in range(6)]
    stored = []
    for b in base:
        for _ in range(60):
            x = list(b)
            for _ in range(draw.randint(0, 6)):
                at = draw.randrange(128)
                x[at // 64] ^= 1 << at % 64
            stored.append((x, draw.randint(1, 3)))
    signed = lambda x: [v - (1 << 64) if v >> 63 else v for v in x]
    df = spark.createDataFrame([(signed(x), n) for x, n in stored], "fp array<long>, copies long")
    # the number expected changes how many blocks there are, not what is found
    assert {simhash.best_blocks(7, n) for n in (0, 10**7, 10**10)} >= {5, 8}
    for radius, expected in ((1, 0), (3, 10**6), (7, 0), (7, 10**7), (7, 10**10)):
        found = simhash.near_counts(df, df.limit(50), radius, expected)
        got = {tuple(r.fp): r.n_near for r in found.collect()}
        rows = {tuple(signed(x)): x for x, _ in stored}
        for key, near in got.items():
            apart = [
                (sum((a ^ b).bit_count() for a, b in zip(rows[key], x)), n) for x, n in stored
            ]
            assert near == sum(n for d, n in apart if d <= radius)


def test_near_copies_are_named(spark, docs_of):
    """Edited copies further apart than 3 bits, by all pairs."""
    draw = random.Random(12)
    words = [f"{draw.getrandbits(40):x}"[: draw.randint(2, 9)] for _ in range(3000)]
    texts = []
    for n in range(6):
        base = words[400 * n : 400 * n + 300]
        for k in range(8):
            texts.append(" ".join(draw.choice(words) if draw.random() < 0.004 * k else w for w in base))
    ids = [n if n % 8 else 100 * (n // 8) for n in range(len(texts))]
    ids = [i + 1000 if n % 8 else i for n, i in enumerate(ids)]
    prints = {i: fingerprint(t) for i, t in zip(ids, texts)}
    rows = simhash.edits_and_neighbours(docs_of(texts, ids=ids)).collect()
    far = 0
    for r in rows:
        apart = sorted(
            ((int(prints[r.doc_id], 16) ^ int(p, 16)).bit_count(), i) for i, p in prints.items()
        )
        # equal texts are one entry under their smallest id
        want = {}
        for d, i in apart:
            if d <= simhash.COPY_RADIUS:
                want[prints[i]] = (d, min(i, want.get(prints[i], (0, i))[1]), want.get(prints[i], (0, 0, 0))[2] + 1)
        assert r.class_id == min(i for i, p in prints.items() if p == prints[r.doc_id])
        if r.doc_id % 100:
            assert r.near_classes is None and r.n_copies is None
            continue
        assert [tuple(x) for x in r.near_classes] == sorted(want.values())
        assert r.n_copies == sum(n for _, _, n in want.values())
        far += sum(d > 3 for d, _, _ in want.values())
    assert far > 10


def test_crowd_of_equal_texts_is_one_class(docs_of):
    """Their rows grow with the table, not with its square."""
    rows = simhash.edits_and_neighbours(docs_of(["same text here"] * 600 + ["other words"])).collect()
    assert {r.class_id for r in rows} == {0, 600}
    for r in rows:
        if r.doc_id % 100 == 0:
            assert len(r.near_classes) == 1 and r.n_near == r.n_copies == (1 if r.doc_id == 600 else 600)


# --- languages


def test_languages_held_out(spark, sf_dir):
    sf = sf_dir.replace("0.001", "0.01")
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = queries.op5_language(spark, sf).join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    held = [r for r in rows if r.held_out]
    assert 0.2 < len(held) / len(rows) < 0.3
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(docs_of):
    german, french = "der hund läuft über die straße", "où est la bibliothèque française"
    texts = [german] * 8 + [french] * 8 + [None, "", "12 !?", "straße", "bibliothèque " * 3000]
    langs = ["de"] * 8 + ["fr"] * 8 + [None, "de", "fr", None, None]
    docs = docs_of(texts, langs=langs).withColumn("gram", F.lit(1)).withColumn("slot", F.lit(2))
    model = language.learn(docs)
    rows = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert [rows[n].lang_pred for n in (0, 8, 16, 17, 18, 19, 20)] == [
        "de", "fr", "und", "und", "und", "de", "fr",
    ]
    assert rows[16].score == rows[17].score == rows[18].score == 0
    assert language.learn(docs.limit(0)) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).collect() == []


def test_copies_are_learnt_once(docs_of):
    texts = ["der hund läuft", "die straße ist lang", "où est la gare", "la bibliothèque"]
    langs = ["de", "de", "fr", "fr"]
    once = language.learn(docs_of(texts, langs=langs), sample=2)
    crowd = docs_of(texts + [texts[0]] * 300 + [texts[2]] * 200, langs=langs + ["de"] * 300 + ["fr"] * 200)
    often = language.learn(crowd, sample=2)
    assert once.masks.any() and (once.masks == often.masks).all()
    assert [r.lang_pred for r in language.identify(crowd.filter("doc_id < 4"), often).collect()] == langs


def test_more_languages_than_a_byte(docs_of):
    texts, langs = [], []
    for n in range(11):
        a = chr(0x400 + 3 * n)
        texts += [f"{a}{a}{chr(0x401 + 3 * n)} {a}"] * 4
        langs += [f"l{n:02d}"] * 4
    docs = docs_of(texts, langs=langs)
    rows = language.identify(docs, language.learn(docs)).collect()
    assert all(r.lang_pred == langs[r.doc_id] for r in rows)


def test_grams_hold_no_border_inside():
    hashes, owner, letters = language.grams(["ab  cd", "", "x", "12"])
    assert letters.tolist() == [4, 0, 1, 0]
    # of "_ab_" and "_cd_": 2 letters, 3 pairs, 2 triples and 1 quadruple each; of "_x_" 1, 2, 1
    assert Counter(owner.tolist()) == {0: 16, 2: 4}
    assert len(set(hashes.tolist())) == 20


# --- quality


def counts_of(text):
    words = WORD.findall(text or "")
    lines, dup = Counter(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += lines[line] > 0
            lines[line] += 1
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(inside), failed


def test_counts_same_as_brute_force(spark, sf_dir, docs_of):
    draw = random.Random(8)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += ["".join(draw.choice("ab \n\t#é ") for _ in range(draw.randint(0, 80))) for _ in range(200)]
    texts += [None, "", "w " * 20_000, "a b c d e a b c d e f", "x\n x\nx\n\n \nx"]
    docs = docs_of(texts).withColumn("probability", F.lit("x")).withColumn("n_words", F.lit(1))
    rows = quality.judge(docs, None).collect()
    assert len(rows) == len(texts)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == counts_of(texts[r.doc_id]), repr((texts[r.doc_id] or "")[:80])
        assert r.kept == (not r.base_failed) and r.probability is None
    assert quality.judge(docs.limit(0), None).collect() == []


def test_quality_held_out(spark, sf_dir):
    sf = sf_dir.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels.filter("doc_id % 3 != 0"))
    rows = quality.judge(docs, model).join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.9 * len(good)
    assert sum(r.kept for r in bad) <= 0.25 * len(bad)
    assert all(0 <= r.probability <= 1 and not (r.base_failed and r.kept) for r in rows)
    kept = quality.good_documents(docs.withColumn("doc", F.lit(1)), labels.limit(0))
    assert kept.columns == [*docs.columns, "doc"]
    assert quality.train(docs, labels.filter("quality = 1")) is None


# --- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def plain_spans(text):
    out = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    out += [
        (m.start(), m.end(), "ip") for m in IP.finditer(text)
        if all(int(p) <= 255 for p in m[0].split("."))
    ]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], personal_data.KINDS.index(s[2])))


def test_patterns_same_as_plain_ones():
    draw = random.Random(9)
    for _ in range(20_000):
        text = "".join(draw.choice("aZ0123456789.@-+ ()%_é,\n") for _ in range(draw.randint(1, 30)))
        assert personal_data.base_spans(text) == plain_spans(text), text
    for text in ("1" * 50_000, "a." * 30_000, "+1" + " " * 50_000, "0.0.0.0000256", "a@" * 20_000):
        assert personal_data.base_spans(text) == ([] if text[0] != "0" else plain_spans(text))


@pytest.fixture(scope="module")
def spans_model(spark, sf_dir):
    return personal_data.train(spark.read.parquet(f"{sf_dir.replace('0.001', '0.1')}/documents.parquet"), sample=600)


def test_field_finds_what_the_patterns_lose(spans_model):
    text = "un +1 (843) 555-7672 170.106.47.218 Et 4539148803436467 4539148803436467."
    base, every = personal_data.find_spans(text, spans_model)
    assert [s[2] for s in base] == ["ip"]
    assert [text[a:b] for a, b, _ in every] == [
        "+1 (843) 555-7672", "170.106.47.218", "4539148803436467", "4539148803436467",
    ]
    for clean in ("version 3.0.1 of 2024-05-06", "no 9807915762804490 card", "4.0. 1999", "a + b @ c"):
        assert personal_data.find_spans(clean, spans_model)[1] == []


def test_secrets(spark, sf_dir, spans_model):
    """Runs of the planted form, wherever they stand; texts without finds are left alone."""
    key = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"
    for text in (f'x token = "{key}" y', f'x "{key}" y', f"x {key.upper()}, y", f'token="{key}"###'):
        assert [text[a:b].lower() for a, b, k in personal_data.find_spans(text, spans_model)[1] if k == "secret"] == [key]
    for clean in ("release-2024-05-06T07-08-09Z", "a-word-of-many-parts-2nd-try", "0" * 40, "x1 y2 z3 a4 b5 c6 d7"):
        assert personal_data.find_spans(clean, spans_model)[1] == []
    # rows that the field was not fitted on
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    planted = re.compile("[0-9a-f]{40}", re.IGNORECASE)
    with_key = {k for k, t in texts.items() if planted.search(t)}
    rows = personal_data.detect(docs, spans_model).collect()
    found = {r.doc_id for r in rows if "secret:" in r.spans}
    assert with_key and len(found & with_key) >= 0.9 * len(with_key)
    assert found <= with_key
    for r in rows:
        assert r.n_spans == len(r.spans.split(",")) if r.spans else r.n_spans == 0


def test_no_named_secret_no_find(docs_of):
    """Without a value of a name the field has not seen a secret and adds none."""
    model = personal_data.train(docs_of(["mail a.b@c.de of 1.2.3.4", "no 12 of 34"]))
    assert model.spans("x 9b0b3c6a43eb78aa99cbd7049c572391524f37a8 y") == []


def test_sample_counts_copies_once(docs_of):
    """A crowd of copies does not push the other texts out of the sample."""
    rare = [f"mail n{n}@host{n}.org now" for n in range(40)]
    model = personal_data.train(docs_of(["the year 1999"] * 2000 + rare), sample=100)
    assert model.weights and any(f.startswith("email|") for f in model.weights)


def test_cut_is_the_best_of_all(spans_model):
    """The programme against every way to cut short windows."""
    for text in ("+1 843 555 7672 8", "a@b.c.d 12", "1.2.3.4.5.6", "99 a1@x.y"):
        lattice = personal_data.Lattice(text)
        n = len(lattice.bounds)
        edges = {i: [(i + 1, None, [lattice.outside[i]]), *lattice.segments[i]] for i in range(n)}

        def cuts(at):
            if at == n:
                yield 0.0, []
            for j, kind, features in edges.get(at, []):
                for score, rest in cuts(j):
                    own = [(lattice.bounds[at][0], lattice.bounds[j - 1][1], kind)] if kind else []
                    yield score + spans_model._score(features), own + rest

        best = max(score for score, _ in cuts(0))
        found = spans_model.decode(text)
        assert any(rest == found and score == pytest.approx(best) for score, rest in cuts(0))


def test_detect_edges(docs_of, spans_model):
    texts = [None, "", "é x@y.zz", "a" * 100_000 + "@b.c", "1 " * 20_000]
    docs = docs_of(texts, ids=[None, 1, 2, 3, 3]).withColumn("spans", F.lit("x"))
    rows = personal_data.detect(docs, spans_model).collect()
    assert sorted((r.n_email, r.spans) for r in rows) == sorted(
        [(0, ""), (0, ""), (1, "email:2:8"), (1, "email:0:100004"), (0, "")]
    )
    empty = hashlib.sha256(b"").hexdigest()
    assert {r.base_sha256 for r in rows if not r.spans} == {empty}
    assert personal_data.detect(docs.limit(0), spans_model).collect() == []
    assert personal_data.train(docs.limit(0)).spans("x@y.zz 1.2.3.4") == []
