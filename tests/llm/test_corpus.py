"""Corpus operators on small tables, against plain versions and corner cases."""

import hashlib
import os
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from compare import differences

import corpus_pipeline
from medloom.llm import chat, cotrain, decontam, mixing, pii, registry, rules, simhash, substring, toxicity, warc
from medloom.llm.components import components
from medloom.llm.words import words

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, terms string, size string, m string, fp string, kept string, score string, bucket string"
RNG = np.random.default_rng(3)
VOCAB = ["".join(RNG.choice(list("abcdefgh"), 5)) for _ in range(400)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCAB, n))


def odd_rows():
    same = prose(120, 1)
    texts = [None, "", " \n\t ", "one", same, same, same[:-6] + "zzzzz", prose(60_000, 2), "é中\U0001f600  x " * 30, prose(70, 4) + " " + same]
    rows = [(i, t, "en" if i % 3 else None, "s" if i % 2 else None, None if t is None else len(t), *["x"] * 7) for i, t in enumerate(texts)]
    return [*rows, rows[4], (None, same, "en", "s", 9, *["x"] * 7)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(6)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, prose(30, 9)), (2, None), (3, ""), (4, "just three words"), (5, prose(30, 9))], "item_id long, text string")


def plain_pii(text):
    found = []
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    for kind, p in enumerate(patterns):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10 == 0
            if [True, all(int(x) < 256 for x in m[0].split(".") if kind == 1), 14 <= len(digits) <= 19 and luhn, 10 <= len(digits) <= 15][kind]:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


@pytest.mark.parametrize("name", ["op2_pii", "op6_chat", "op8_substring", "op9_warc", "op10_rules"])
def test_query_equals_sql(spark, name):
    assert differences(registry.queries()[name](spark, SF), registry.oracle_sql()[name], SF) == ""


def test_mixing_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.sql(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.ORACLE})").fetchall())
    assert sorted(map(tuple, registry.op1_mixing(spark, SF).collect())) == want


def test_mixing_odd_rows(odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert set(odd.columns) <= set(rows[0].asDict())
    assert mixing.mix(odd.limit(0)).count() == 0


def test_pii_equals_plain_patterns(spark):
    bits = ["a@b.c", "_d@e.f-g.h", "1.2.3.4.5.6", "256.1.1.1", "00.01.255.9", "4111 1111-1111 1111", "4111111111111112", "+1 (988) 555-2485", "+12345", "x+@y.z@w.v", "é\U0001f600", "9" * 40, ".", "..", "@", "a@b", " ", "\n", "-", "1" * 14]
    texts = ["".join(np.random.default_rng(i).choice(bits, 12)) for i in range(400)] + [None, "", "4" * 5000, "a" * 5000 + "@", "a." * 3000 + "@b.c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(df).select("text", "base").collect():
        assert [tuple(x) for x in r.base] == plain_pii(r.text if r.text else ""), r.text


def test_pii_terms_that_disclose(spark):
    said = [f"{prose(20, i)} nightingale reports to boss@corp.example daily" for i in range(6)]
    rest = [prose(30, 100 + i) for i in range(60)]
    df = spark.createDataFrame(list(enumerate([*said, *rest])), "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert "nightingale" not in out[0] and "boss" not in out[0] and "[EMAIL]" in out[0] and "[TERM]" in out[0]
    assert all(out[6 + i] == t for i, t in enumerate(rest))
    spans = pii.find(df).where("doc_id = 0").select(pii.joined(F.col("spans")).alias("s")).first().s
    at = said[0].index("nightingale")
    assert f"term:{at}:{at + 11}" in spans.split(",")


def test_pii_of_a_text_with_many_matches(spark):
    n = 50_000
    text = " ".join(f"u{i}@host.example" for i in range(n))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.monotonic()
    r = pii.find(df).first()
    assert r.n_email == n and [tuple(x) for x in r.base] == plain_pii(text)
    assert pii.sanitise(df).first().text == " ".join(["[EMAIL]"] * n)
    assert time.monotonic() - began < 120


def test_pii_many_entities_and_words_in_one_text(spark):
    # 600 entities and 600 words that always stand together are paired once, not 360,000 times
    said = " ".join(f"person{i} u{i}@host.example" for i in range(600))
    df = spark.createDataFrame([(i, f"{prose(10, i)} {said}") for i in range(4)] + [(9 + i, prose(20, 50 + i)) for i in range(40)], "doc_id long, text string")
    pairs, stage = [], pii.stage
    pii.stage, kept = lambda d, name: (pairs.append(out) if name == "pairs" else None, out)[1] if (out := stage(d, name)) is not None else None, pii.stage
    try:
        rows = pii.find(df).where("doc_id < 9").collect()
    finally:
        pii.stage = kept
    assert all(sum(x.kind == 4 for x in r.spans) == 600 and r.n_email == 600 for r in rows)
    assert pairs[0].count() <= 4 * 20


def test_columns_with_working_names_stay(spark):
    names = "row k rest email __text __base __bucket __source __k t base spans hash name leaf fp".split()
    df = spark.createDataFrame([(i, prose(60, i), "en", "s", 400, *[f"{c}{i}" for c in names]) for i in range(6)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in names))
    for out, gone in ((pii.find(df), {"base", "spans"}), (pii.sanitise(df), set()), (mixing.mix(df), set()), (simhash.keep_first(df), set()), (cotrain.keep_good(df, df.select("doc_id", F.lit(1).alias("quality")).limit(0)), set())):
        rows = {r.doc_id: r for r in out.collect()}
        assert len(rows) == 6 and all(r[c] == f"{c}{i}" for i, r in rows.items() for c in set(names) - gone)


def test_pii_odd_rows(odd):
    out = pii.sanitise(odd)
    assert out.columns == odd.columns and out.count() == odd.count() and out.where("doc_id = 0").first().text is None
    assert pii.find(odd.limit(0)).count() == 0


def test_quality_learns_and_survives_odd_rows(spark, odd, labels):
    good = [(i, prose(80, i), "en", "s", 400) for i in range(150)]
    bad = [(1000 + i, " ### ".join(prose(40, i).upper().split()), "en", "t", 400) for i in range(150)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame([(r[0], int(r[0] < 1000), 0) for r in good[:100] + bad[:100]], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r.kept for r in cotrain.score(df, marks).collect()}
    assert sum(out[i] for i in range(150)) >= 147 and sum(out[1000 + i] for i in range(150)) <= 5
    assert cotrain.score(odd, labels).count() == odd.count()
    assert cotrain.score(odd, labels.limit(0)).where("kept").count() == odd.count()
    assert cotrain.keep_good(odd, labels).columns == odd.columns and cotrain.score(odd.limit(0), labels).count() == 0


def test_quality_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, marks = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = cotrain.score(docs, marks.where("doc_id % 2 = 0")).join(marks.where("doc_id % 2 = 1"), "doc_id").select("kept", "quality").toPandas()
    good, bad = out.kept[out.quality == 1], out.kept[out.quality == 0]
    print("quality", len(good), good.sum(), len(bad), bad.sum())
    assert good.mean() > 0.99 and bad.mean() < 0.05


def test_surest_rows_equal_plain():
    r = np.random.default_rng(0)
    margin, rank = r.normal(0, 2, 3000).round(1), r.integers(0, 400, 3000)
    for n, low in ((40, True), (10, False), (0, True), (500, False)):
        best = cotrain.Surest(n, low)
        for i in range(0, 3000, 70):
            best.add(margin[i : i + 70], rank[i : i + 70], rank[i : i + 70] * 2)
        sign, want = 1 if low else -1, {}
        for m, k in zip(margin.tolist(), rank.tolist(), strict=True):
            if sign * m < 0:
                want[m] = min(want.get(m, k), k)
        want = [(m, want[m], 2 * want[m]) for m in sorted(want, key=lambda m: sign * m)[:n]]
        assert [tuple(x) for x in zip(*[c.tolist() for c in best.rows], strict=True)] == want


def test_a_round_equals_plain_python(spark, monkeypatch):
    """The rows exchanged in each round, and the model, recomputed from all views at once."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 600")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("doc_id < 600")
    seen, surest = [], cotrain.surest
    monkeypatch.setattr(cotrain, "surest", lambda d, m, n, s: (seen.append((d, m, n, s, surest(d, m, n, s))), seen[-1][-1])[1])
    cotrain.fit(docs, marks)
    assert len(seen) == cotrain.ROUNDS
    for others, model, n, share, given in seen:
        t = others.toPandas()
        a, b = cotrain.content(pa.array(t.text.fillna(""), pa.string())), cotrain.metadata(t.source.tolist(), t.lang.tolist(), [None if x != x else x for x in t.n_chars.tolist()], pa.array(t.text.fillna(""), pa.string()))
        m = model.margins(a, b).astype(float).round(4)
        for v in (0, 1):
            want = set()
            for y, many in ((0, round(n * (1 - share))), (1, round(n * share))):
                sign, best = (-1 if y else 1), {}
                for k, x in zip(t["rank"].tolist(), m[:, v].tolist(), strict=True):
                    if sign * x < 0:
                        best[x] = min(best.get(x, k), k)
                want |= {(best[x], y) for x in sorted(best, key=lambda x: sign * x)[:many]}
            by_rank = {k: i for i, k in enumerate(t["rank"])}
            order = sorted(want)
            # margins of equal rows may round to neighbours in another batch: nearly all must agree
            got = {(r.tobytes(), int(y)) for r, y in zip(given[v].b.astype(bool), given[v].y, strict=True)}
            mine = {(b[by_rank[k]].astype(bool).tobytes(), y) for k, y in order}
            assert len(given[v].y) == len(want) and len(got & mine) >= 0.9 * len(mine)


def test_a_fit_reads_texts_once_a_round(spark, odd, labels, tmp_path):
    odd.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    plans, staged, fetched = [], cotrain.stage, cotrain._fetched
    note = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    cotrain.stage = lambda df, name: (note(df), staged(df, name))[1]
    cotrain._fetched = lambda df: (note(df), fetched(df))[1]
    try:
        note(cotrain.score(docs, labels))
    finally:
        cotrain.stage, cotrain._fetched = staged, fetched
    scans = [x for p in plans for x in re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*", p) if "text#" in x]
    assert len(scans) == 2 + cotrain.ROUNDS


def test_classifiers_learn_from_one_row_of_a_document(spark):
    rows = [(i % 5, f"{prose(30, i)} {'### ' * (i % 5)}", "en", "s", 9) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame([(i, i % 2, i % 2) for i in range(4)], "doc_id long, quality int, toxic int")
    sizes, fetched, fit = [], cotrain._fetched, toxicity._fit
    cotrain._fetched = lambda d: (out := fetched(d), sizes.append(len(out.y)))[0]
    toxicity._fit = lambda b, rows, label, **k: (sizes.append(len(label)), fit(b, rows, label, **k))[1]
    try:
        assert cotrain.score(df, marks).count() == toxicity.score(df, marks).count() == 3000
    finally:
        cotrain._fetched, toxicity._fit = fetched, fit
    assert sizes[0] == 4 and sizes[-1] <= 4 and max(sizes) <= cotrain.EXCHANGED
    text = df.withColumn("doc_id", F.col("doc_id").cast("string"))
    names = marks.withColumn("doc_id", F.col("doc_id").cast("string"))
    assert cotrain.score(text, names).count() == toxicity.score(text, names).count() == 3000


def test_scores_of_a_query_equal_plain_ones(spark, monkeypatch):
    """Every score of op3 and op5, recomputed text by text, op5's with plain pairs of terms."""
    made = {}
    for module in (cotrain, toxicity):
        monkeypatch.setattr(module, "fit", lambda d, x, m=module, f=module.fit: made.setdefault(m, f(d, x)))
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good, toxic = (registry.queries()[q](spark, SF).collect() for q in ("op3_quality", "op5_toxicity"))
    assert len(good) == len(toxic) == len(docs)
    for r in good:
        d = docs[r.doc_id]
        text = pa.array([d.text or ""], pa.string())
        one = made[cotrain].score(cotrain.content(text), cotrain.metadata([d.source], [d.lang], [d.n_chars], text))[0]
        assert r.score == pytest.approx(one, abs=1e-4) and r.kept == (r.score >= 0.5)
    m = made[toxicity]
    place = {b: i for i, b in enumerate(m.buckets.tolist())}
    for r in toxic:
        terms = sorted({place[b] for b in toxicity._terms(pa.array([docs[r.doc_id].text or ""], pa.string()))[1].tolist() if b in place})
        margin = m.bias + sum(m.weight[i] for i in terms) + sum(float(m.factor[i] @ m.factor[j]) for x, i in enumerate(terms) for j in terms[x + 1 :])
        assert r.score == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-9) and r.predicted == (r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_decontamination_equals_plain_similarity(spark, benchmark, odd):
    item = prose(30, 9).split()
    near = [*item]
    near[29] = "changed"
    far = [*item]
    far[10] = far[20] = "changed"
    texts = [prose(50, 20) + " " + " ".join(item) + "\n" + prose(50, 21), prose(9, 22) + " " + " ".join(near).upper(), prose(40, 23) + " " + " ".join(far), prose(300, 24), "we have just three words here", " ".join(item)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontam.matches(df, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(0, 1), (0, 5), (1, 1), (1, 5), (4, 4), (5, 1), (5, 5)}
    assert {(r.first_word, r.end_word) for r in found if r.doc_id == 0} == {(50, 80)}
    assert {r.doc_id for r in decontam.keep_clean(df, benchmark).collect()} == {2, 3}
    assert decontam.matches(odd, benchmark).count() == 0 and decontam.keep_clean(odd, benchmark).columns == odd.columns
    assert decontam.matches(df, benchmark.limit(0)).count() == 0 and decontam.matches(df.limit(0), benchmark).count() == 0


def test_decontamination_does_not_depend_on_parts(spark, monkeypatch):
    # items share passages, so a part alone would weigh shingles otherwise
    r = np.random.default_rng(5)
    shared = [prose(20, 900 + i) for i in range(4)]
    items = [(i, f"{prose(20, i)} {shared[i % 4]}" if i % 2 else f"{shared[i % 4]} {prose(20, i)}") for i in range(40)]
    items += [items[3]] * 3 + [(50, items[3][1]), (None, items[3][1]), (51, None), (52, "two words")]
    texts = []
    for i in range(120):
        text = items[i % 40][1].split()
        for at in r.integers(0, 40, i % 3):
            text[at] = "changed"
        texts.append(f"{prose(9, i)} {' '.join(text)} {prose(9, i + 1)}")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, decontam.matches(df, benchmark).collect()), key=repr)
    clean = {x.doc_id for x in decontam.keep_clean(df, benchmark).collect()}
    assert 40 < len({x[0] for x in whole}) < 120 and len(clean) == 120 - len({x[0] for x in whole})
    assert Counter(x[1] for x in whole if x[0] == 3) == {3: 4, 50: 1, None: 1}
    near = lambda rows: [(*x[:5], round(x[5], 9)) for x in rows]
    for part, bits in ((2000, decontam.MOST_BITS), (0, 1 << 20), (0, 1 << 16)):  # the smallest map is full of other shingles
        monkeypatch.setattr(decontam, "PART_BYTES", part)
        monkeypatch.setattr(decontam, "MOST_BITS", bits)
        assert near(sorted(map(tuple, decontam.matches(df.union(df.where("doc_id = 3")), benchmark).collect()), key=repr)) == near(sorted([*whole, *[x for x in whole if x[0] == 3]], key=repr))
        clash = df.withColumn("t", F.lit(1)).withColumn("name", F.lit("x"))
        kept = decontam.keep_clean(clash, benchmark)
        assert {x.doc_id for x in kept.collect()} == clean and kept.columns == clash.columns
    assert decontam.matches(df.limit(0), benchmark).count() == 0 and decontam.keep_clean(df, benchmark.where("item_id = 51")).count() == 120


def test_decontamination_reads_texts_twice_at_most(spark, monkeypatch, tmp_path):
    spark.createDataFrame([(i, prose(60, i)) for i in range(40)], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    benchmark = spark.createDataFrame([(i, prose(30, i)) for i in range(200)], "item_id long, text string")
    plans, staged = [], decontam.stage
    note = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(decontam, "stage", lambda df, name: (note(df), staged(df, name))[1])
    for part, most in ((1 << 20, 1), (2000, 2)):
        plans.clear()
        monkeypatch.setattr(decontam, "PART_BYTES", part)
        note(decontam.keep_clean(docs, benchmark))
        scans = [x for p in plans for x in re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*/d\]", p) if "text#" in x]
        assert len(scans) <= most + 1  # and that which decides what stays


def test_blocks_guarantee_all_within_the_radius(monkeypatch):
    r = np.random.default_rng(0)
    held = r.integers(0, 2**63, 400, dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, 400, dtype=np.uint64)
    asked = np.array([held[i % 400] ^ np.bitwise_or.reduce(np.uint64(1) << r.choice(64, i % 22, replace=False).astype(np.uint64)) if i % 22 else held[i % 400] for i in range(1500)], np.uint64)
    a, b = np.nonzero(np.bitwise_count(asked[:, None] ^ held[None, :]) <= decontam.RADIUS)
    tables, everything = decontam.Tables.of(held), np.ones(400, bool)
    for pairs in (decontam.PAIRS, 100):
        monkeypatch.setattr(decontam, "PAIRS", pairs)
        w, i, bits = tables.candidates(asked, everything)
        assert list(zip(w.tolist(), i.tolist(), strict=True)) == list(zip(a.tolist(), b.tolist(), strict=True)) and len(a) > 900
        assert (bits == np.bitwise_count(asked[w] ^ held[i])).all()
    monkeypatch.setattr(decontam, "PAIRS", 1 << 21)
    strange = r.integers(0, 2**63, 2000, dtype=np.uint64)
    met = {p for w, i in tables.met(strange) for p in zip(w.tolist(), i.tolist(), strict=True)}
    assert len(met) < 0.05 * len(strange) * len(held)


def plain_matches(text, items, weights):
    """Items with a window of weighted similarity 0.8, by comparing every window."""
    h = words(pa.array([text]), lower=True).hashes()
    found = set()
    for name, n, bag in items:
        k = min(decontam.SHINGLE, n)
        g = decontam.runs(h, k)
        for a in range(len(h) - n + 1):
            window = Counter(g[a : a + n - k + 1].tolist())
            if not window.keys() & bag.keys():
                continue
            weight = dict(zip(window.keys() | bag.keys(), weights.of(np.array(list(window.keys() | bag.keys()), np.uint64)).tolist(), strict=True))
            both, either = (sum(f(window.get(s, 0), bag.get(s, 0)) * x for s, x in weight.items()) for f in (min, max))
            if both >= 0.8 * either:
                found.add(name)
                break
    return found


def test_decontamination_recall_against_every_window(spark):
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    weights = decontam.count([(1, t) for _, t in benchmark])
    items = [(name, len(t.split()), Counter(decontam._shingles(pa.array([t]))[0].tolist())) for name, t in benchmark]
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    for i in range(400):  # and items with edits
        r = np.random.default_rng(i)
        t = benchmark[i % len(benchmark)][1].split()
        for at in r.integers(0, len(t), int(r.integers(0, 4))):
            t[at] = "changed"
        docs.append((100_000 + i, f"{prose(20, i)} {' '.join(t)} {prose(20, i + 1)}"))
    want = {(d, name) for d, t in docs for name in plain_matches(t, items, weights)}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.matches(df, spark.createDataFrame(benchmark, "item_id long, text string")).collect()}
    planted = {p for p in want if p[0] < 100_000}
    edited = want - planted
    print("recall", len(planted), len(got & planted), len(edited), len(got & edited))
    assert got <= want and len(got & planted) >= 0.9 * len(planted) and len(got & edited) >= 0.9 * len(edited)


def test_decontamination_of_a_dump_and_of_any_ids(spark):
    items = [(f"item {i}", prose(30, i)) for i in range(1000)]
    df = spark.createDataFrame([("dump", " ".join(t for _, t in items)), (None, items[0][1]), ("x", None)], "doc_id string, text string")
    benchmark = spark.createDataFrame([*items, (None, items[0][1])], "item_id string, text string")
    found = Counter((r.doc_id, r.item_id) for r in decontam.matches(df, benchmark).collect())
    assert found == Counter([("dump", n) for n, _ in items] + [("dump", None), (None, "item 0"), (None, None)])


def test_toxicity_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    out = registry.op5_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").select("score", "toxic", "predicted").toPandas()
    rank, p = out.score.rank(), int(out.toxic.sum())
    assert (rank[out.toxic == 1].sum() - p * (p + 1) / 2) / (p * (len(out) - p)) > 0.93
    assert out.predicted[out.toxic == 0].mean() < 0.01


def test_machine_learns_a_pair(spark):
    rows = []
    for i in range(1200):
        a, b = i % 2, (i // 2) % 2
        rows.append((i, f"{prose(5, i)} {'insult' if a else ''} {'group' if b else ''}", int(a and b)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    m = toxicity.fit(df, df.select("doc_id", "toxic"))
    import pyarrow as pa

    s = m.score(pa.array(["insult group", "insult", "group", ""]))
    assert s[0] > 0.5 > max(s[1:])


def test_terms_that_matter_only_beside_others(spark):
    # a mention is as common in clean texts as in toxic ones, but decides among those with an insult
    rows = []
    for i in range(3000):
        insult, mention = i % 4 == 0, i % 8 < 2 or i % 8 in (5, 6) and i % 3 == 0
        toxic = insult and (mention or i % 40 == 4)
        rows.append((i, f"{prose(5, i)} {'insult' if insult else ''} {'mention' if mention else ''}", int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    m = toxicity.fit(df, df.select("doc_id", "toxic"))
    wanted = toxicity._terms(pa.array(["mention"]))[1]
    assert set(wanted.tolist()) & set(m.buckets.tolist())
    s = m.score(pa.array(["insult mention", "mention", "insult", ""]))
    assert s[0] > 0.5 > max(s[1:])


def test_machine_equals_plain_pairs():
    r = np.random.default_rng(2)
    texts = [prose(int(r.integers(0, 30)), i) for i in range(20)]
    buckets = np.unique(toxicity._terms(pa.array(texts))[1])[::3]
    m = toxicity.Machine(buckets, 0.3, r.normal(0, 1, len(buckets)), r.normal(0, 1, (len(buckets), toxicity.FACTORS)))
    got = m.score(pa.array(texts))
    for text, score in zip(texts, got, strict=True):
        held = sorted(set(toxicity._terms(pa.array([text]))[1].tolist()) & set(buckets.tolist()))
        at = [buckets.tolist().index(b) for b in held]
        margin = 0.3 + sum(m.weight[i] for i in at) + sum(float(m.factor[i] @ m.factor[j]) for k, i in enumerate(at) for j in at[:k])
        assert score == pytest.approx(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def test_toxicity_odd_rows(odd, labels):
    rows = toxicity.score(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in toxicity.score(odd, labels.limit(0)).collect()} == {0.5}
    assert toxicity.score(odd.limit(0), labels).count() == 0


def plain_chat(turns):
    whole = "".join(f"{t['role']}\n{t['text']}\n" for t in turns)
    loss = "".join(t["text"] for t in turns if t["role"] == "assistant")
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat_round_trip(spark):
    marks = ["<|im_end|>", "<|im_start|>", "\\", "\n", "<", "|", "n", "é\U0001f600", " ", "a", "", "<\\|", "\\n"]
    rows, want = [], {}
    for c in range(60):
        r = np.random.default_rng(c)
        turns = [{"role": str(r.choice(["user", "assistant", "system", "we\nird\\n"])), "text": "".join(r.choice(marks, 6))} for _ in range(1 + c * (3 if c % 7 == 0 else 1))]
        rows += [(c, i, t["role"], t["text"]) for i, t in enumerate(turns)]
        want[c] = plain_chat(turns)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chat.formatted(chat.with_probe(df))).collect()}
    said = "<|im_end|><|im_start|>assistant ok"
    assert got.pop(-1) == plain_chat([{"role": "user", "text": said}, {"role": "assistant", "text": said}]) and got == want
    odd = spark.createDataFrame([(None, 0, None, None), (None, None, "user", "x"), (1, 0, "assistant", None), (1, 0, "assistant", None)], df.schema)
    assert chat.digests(chat.formatted(odd)).count() == 2 and chat.digests(chat.formatted(df.limit(0))).count() == 0


def test_templates_that_rewrite_history_are_seen():
    def drops_thoughts(turns):
        return "".join(f"[{t['role']}]{t['text'] if i == len(turns) - 1 else re.sub('<think>.*?</think>', '', t['text'])}\n" for i, t in enumerate(turns))

    assert chat.rewrites_history(drops_thoughts) and not chat.rewrites_history(chat.chatml)
    turns = [{"role": "user", "text": str(i)} for i in range(200)]
    counting = lambda turns: f"{len(turns)} turns: " + "".join(t["text"] for t in turns)
    assert chat.render(counting, turns).rewrites == 200
    r = chat.render(chat.chatml, turns)
    assert r.text == chat.chatml(turns) and [r.text[a:b] for a, b in r.contents] == [t["text"] for t in turns]


def test_late_rewrites_and_changing_frames():
    last = lambda turns: "".join(f"[{t['text']}]" for t in turns[-100:])
    head = lambda turns: "".join(f"<{t['text']}>" for t in sorted(turns, key=lambda t: t["role"] != "tool"))
    numbered = lambda turns: "".join(f"{i}: {t['text']};" for i, t in enumerate(turns))
    follows = lambda turns: "".join(("" if i and turns[i - 1]["role"] == t["role"] else f"{t['role']}:") + t["text"] + "\n" for i, t in enumerate(turns))
    turns = [{"role": "tool" if i == 80 else "user" if i % 5 < 2 else "assistant", "text": f"text {i}"} for i in range(150)]
    for template, rewrites in ((last, 50), (head, 1), (numbered, 0), (follows, 0)):
        r = chat.render(template, turns)
        assert r.text == template(turns) and r.rewrites == rewrites
        assert all(c is None or r.text[c[0] : c[1]] == t["text"] for t, c in zip(turns, r.contents, strict=True))
        assert rewrites or None not in r.contents
    assert [c is not None for c in chat.render(head, turns).contents] == [i > 80 for i in range(150)]
    assert chat.rewrites_history(last)


def test_rendering_equals_that_of_whole_prefixes():
    turns = [{"role": ("user", "assistant")[i % 2], "text": f"text {i}"} for i in range(150)]
    templates = [lambda t, n=n: "".join(f"[{x['text']}]" for x in t[-n:]) for n in (70, 80)]
    templates += [lambda t, n=n: "".join(f"[{x['text'] if i >= len(t) - n else x['text'][:3]}]" for i, x in enumerate(t)) for n in (66, 100)]
    templates.append(lambda t: ("late " if 96 <= len(t) < 140 else "") + "".join(x["text"] for x in t))
    for template, rewrites in zip(templates, (80, 70, 84, 50, 2), strict=True):
        got = chat.render(template, turns)
        assert got.text == template(turns) and got.rewrites == rewrites


def plain_render(template, turns):
    """Rewrites, and of each turn where its text stands in the last text, from whole prefixes."""
    texts = [template(turns[:i]) for i in range(len(turns) + 1)]
    rewrites, found = 0, []
    for i, (a, b) in enumerate(zip(texts, texts[1:])):
        if b.startswith(a):
            found.append((len(a), len(b)))
        else:
            rewrites += 1
            same = len(os.path.commonprefix([a, b]))
            found = [(x, y) if y <= same else None for x, y in (s or (0, 1 << 60) for s in found)] + [None]
    return rewrites, found


def test_a_banner_that_comes_and_goes_is_seen():
    turns = [{"role": ("user", "assistant")[i % 2], "text": f"text {i}"} for i in range(150)]
    banner = lambda t: ("# banner\n" if 70 <= len(t) <= 75 else "") + "".join(f"<{x['text']}>" for x in t)
    r = chat.render(banner, turns)
    assert r.rewrites == 2 and r.text == banner(turns) and sum(c is None for c in r.contents) == 76


def test_random_templates_equal_plain_comparison():
    for seed in range(200):
        g = np.random.default_rng(seed)
        back, low = int(g.integers(1, 90)), int(g.integers(2, 100))
        high, kind = low + int(g.integers(1, 30)), int(g.integers(0, 4))
        turns = [{"role": str(g.choice(["user", "assistant", "tool"])), "text": f"t{i} {g.integers(0, 9)}"} for i in range(int(g.integers(1, 120)))]

        def template(t, kind=kind, back=back, low=low, high=high):
            if kind == 0:  # a frame that looks back
                return "".join(f"[{x['role']}{t[i - back]['role'] if i >= back else ''}]{x['text']};" for i, x in enumerate(t))
            if kind == 1:  # a mark that comes and goes
                return ("!" if low <= len(t) < high else "") + "".join(f"<{x['text']}>" for x in t)
            if kind == 2:  # only the last turns in full
                return "".join(f"({x['text'] if i >= len(t) - back else ''})" for i, x in enumerate(t))
            return "".join(f"{x['role']}:{x['text']}\n" for x in t)

        r = chat.render(template, turns)
        rewrites, found = plain_render(template, turns)
        assert r.text == template(turns) and r.rewrites == rewrites
        for turn, content, span in zip(turns, r.contents, found, strict=True):
            assert (content is None) == (span is None)
            assert content is None or span[0] <= content[0] and content[1] <= span[1] and r.text[content[0] : content[1]] == turn["text"]
        if kind == 3:
            assert chat.render(template, turns, 1) == r
        if kind == 0:
            assert chat.render(template, turns, back) == r


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def plain_classes(prints, radius=3):
    label = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= radius:
                x, y = label[i], label[j]
                label = [min(x, y) if v in (x, y) else v for v in label]
    return label


def test_simhash_equals_plain(spark, odd):
    rows = simhash.classes(odd).collect()
    texts = {r.doc_id: r.text for r in odd.collect()}
    assert len(rows) == odd.count() and all(r.fp % (1 << 64) == plain_fingerprint(texts[r.doc_id]) for r in rows)
    ids = sorted({r.doc_id for r in rows if r.doc_id is not None})
    label = plain_classes([plain_fingerprint(texts[i]) for i in ids])
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == {i: ids[x] for i, x in zip(ids, label, strict=True)}
    assert simhash.classes(odd.limit(0)).count() == 0
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted({ids[x] for x in label}, key=repr)


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    texts = pa.array([prose(5000, 1), "", "one two", prose(900, 2) + " " + "w" * 5000 + " x", prose(3, 3)], pa.string())
    whole = simhash._fingerprints(texts, 3, 42), words(texts, lower=True).hashes(), toxicity._terms(texts), cotrain.content(texts)
    monkeypatch.setattr(simhash, "HASHES", 100)
    blocks = words.__globals__["Words"].blocks
    monkeypatch.setattr(words.__globals__["Words"], "blocks", lambda self, most=700: blocks(self, most))
    assert whole[0].tolist() == simhash._fingerprints(texts, 3, 42).tolist() == [plain_fingerprint(t) for t in texts.to_pylist()]
    assert whole[1].tolist() == words(texts, lower=True).hashes().tolist() and (whole[3] == cotrain.content(texts)).all()
    assert sorted(zip(*map(np.ndarray.tolist, whole[2]), strict=True)) == sorted(zip(*map(np.ndarray.tolist, toxicity._terms(texts)), strict=True))


def test_keep_first_judges_rows(spark):
    a, b, c = prose(60, 1), prose(60, 2), prose(60, 3)
    rows = [(2, a, "en", 1), (5, a, "en", 1), (5, b, "de", 1), (5, b, "en", 1), (7, b, "en", 1), (8, c, "en", 1), (8, c, "en", 1), (None, c, "en", 1), (None, prose(60, 4), None, 1), (9, None, "en", 1), (3, "", "en", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, hash int")
    out = sorted(simhash.keep_first(df).collect(), key=repr)
    assert sorted([(r.doc_id, r.text) for r in out], key=repr) == sorted([(2, a), (5, b), (8, c), (None, prose(60, 4)), (3, "")], key=repr)
    assert simhash.keep_first(df.limit(0)).count() == 0
    for _ in range(2):
        assert sorted(simhash.keep_first(df.repartition(5)).collect(), key=repr) == out


def test_places_of_a_fingerprint():
    points = np.random.default_rng(0).integers(0, 2**63, 65_536, dtype=np.uint64)
    places = 0
    for x in simhash.parts(points):
        tree = simhash.build(x, 10)
        assert len(tree) > 500
        places += sum(len(own) for _, own, _ in simhash.route(tree, x, simhash.part_radius(simhash.RADIUS)))
    assert places == simhash.PARTS * len(points)


@pytest.mark.parametrize("radius", [3, 6])
def test_vantage_tree_finds_all_links(spark, monkeypatch, radius):
    monkeypatch.setattr(simhash, "SHARD", 64)
    monkeypatch.setattr(simhash, "TILE", 50)
    monkeypatch.setattr(simhash, "LEAF", 8)
    r = np.random.default_rng(1)
    points = list(r.integers(0, 2**63, 400, dtype=np.uint64))
    for _ in range(600):
        p = points[r.integers(len(points))]
        points.append(p ^ np.bitwise_or.reduce(np.uint64(1) << r.choice(64, r.integers(1, 2 * radius), replace=False).astype(np.uint64)))
    points = sorted({int(p) for p in points})
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in points], "fp long")
    label = {r.node % (1 << 64): r.label for r in components(simhash.links(df, radius)).collect()}
    want = plain_classes(points, radius)
    seen = {}
    for p, w in zip(points, want, strict=True):
        got = label.get(p, p)
        assert seen.setdefault(w, got) == got
    assert len(set(seen.values())) == len(seen)


def test_parts_of_near_points_are_equal_or_near():
    r = np.random.default_rng(6)
    a = r.integers(0, 2**63, 20_000, dtype=np.uint64)
    for radius in (1, 3, 4, 6, 9):
        flips = np.zeros(len(a), np.uint64)
        for _ in range(radius):
            flips |= np.uint64(1) << r.integers(0, 64, len(a), dtype=np.uint64)
        least = np.min([np.bitwise_count(x ^ y) for x, y in zip(simhash.parts(a), simhash.parts(a ^ flips), strict=True)], axis=0)
        assert least.max() <= simhash.part_radius(radius)
    assert simhash.part_radius(3) == 0 and all(x.max() < 1 << 22 for x in simhash.parts(a))


def test_shards_stay_even_beyond_the_trees(spark, monkeypatch):
    """Some 15 times as many fingerprints as the leaves of the sample's trees are meant for."""
    for name, value in (("SAMPLE", 512), ("SHARD", 64), ("TILE", 200)):
        monkeypatch.setattr(simhash, name, value)
    points = np.random.default_rng(7).integers(-(2**63), 2**63, 100_000)
    df = spark.createDataFrame([(int(p),) for p in points], "fp long").distinct()
    n = df.count()
    where = simhash.placed(df)
    sizes = [r["count"] for r in where.groupBy("leaf", "sub", "i", "j").count().collect()]
    assert sum(sizes) < 25 * n and sum(sizes) == simhash.PARTS * n
    assert max(sizes) < 4 * np.mean(sizes) and where.select("leaf").distinct().count() * 10 * simhash.SHARD < simhash.PARTS * n


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    out = {r.node: r.label for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert len({out[i] for i in range(301)}) == 1 and len({out[1000 + i] for i in range(200)}) == 1 and out[0] != out[1000]


def plain_cut(rows, window):
    first = {}
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in texts:
        for a in range(len(w) - window + 1):
            key = tuple(w[a : a + window])
            if i is not None:
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in texts:
        gone = set()
        for a in range(len(w) - window + 1):
            if i is not None and first[tuple(w[a : a + window])] < i:
                gone |= set(range(a, a + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [4, 10, 50])
def test_substring_equals_plain(spark, window):
    r = np.random.default_rng(window)
    pieces = [prose(int(r.integers(window // 2, 3 * window)), 50 + i).split() for i in range(6)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(3):
            p = list(pieces[r.integers(6)])
            if r.random() < 0.5:
                p[r.integers(len(p))] = "edit"
            text += p[: int(r.integers(1, len(p) + 1))] + prose(int(r.integers(0, 9)), int(r.integers(5))).split()
        rows.append((int(i % 100), " ".join(text)))
    df = spark.createDataFrame(rows + [(None, rows[0][1]), (7, None), (8, "")], "doc_id long, text string")
    got = sorted(map(tuple, substring.remove_repeats(df, window).collect()), key=repr)
    assert got == plain_cut([(x.doc_id, x.text) for x in df.collect()], window)


@pytest.mark.parametrize("window", [10, 50])
def test_substring_knows_windows_across_covered_words(spark, window):
    # all words of document 3 are covered by the windows of 1 and 2, but not its middle window
    anchor, rows = 8, None
    for seed in range(300):
        c = [f"c{seed}x{i}" for i in range(window + 2)]
        texts = [c[:window] + ["junk1"], ["junk2", *c[2:]], c, ["junk3", *c[1 : window + 1], "junk4"]]
        docs = pa.array([" ".join(t) for t in texts])
        s = substring._segments(words(docs), window, anchor)
        whole = [m for m, t, n in zip(s["m"], s["text"], s["n"], strict=True) if t == 2 and n == window + 2]
        if whole and all(whole[0] in s["m"][s["text"] == t] for t in (0, 1, 3)):
            rows = list(enumerate(docs.to_pylist(), 1))
            break
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, substring.remove_repeats(df, window).collect()), key=repr)
    assert got == plain_cut(rows, window) and got[3][2] == window


@pytest.mark.parametrize("shard", [0, 40])
def test_substring_deals_large_shards(spark, monkeypatch, shard):
    # a passage with an edit of its own in most documents: no task gets all of a shard's segments
    passage = prose(60, 77).split()
    rows = []
    for i in range(240):
        r = np.random.default_rng(i)
        p = list(passage)
        if i % 3:
            p[r.integers(60)] = str(r.choice(VOCAB[:5]))
        rows.append((int(i * 7 % 200), prose(int(r.integers(0, 30)), 500 + i % 90) + " " + " ".join(p) + " " + prose(int(r.integers(0, 30)), 700 + i % 90)))
    rows += [(None, rows[0][1]), (7, None), (8, "")]
    monkeypatch.setattr(substring, "SHARD", shard, raising=False)
    match = substring._match

    def checked(window, anchor):
        run = match(window, anchor)

        def counted(batches):
            def seen():
                held = Counter()
                for b in batches:
                    held.update(b.column("m").to_pylist())
                    if max(held.values(), default=0) > shard:
                        raise ValueError(f"{max(held.values())} segments of a shard in one task")
                    yield b

            yield from run(seen())

        return counted

    monkeypatch.setattr(substring, "_match", checked)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, substring.remove_repeats(df, 20).collect()), key=repr)
    assert got == plain_cut(rows, 20)


def test_ids_of_any_type(spark, monkeypatch):
    rows = [(f"d{i:03}", f"{prose(int(3 * (i % 7)), i)} {prose(70, 5)} {prose(4, 100 + i)}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    for shard in (substring.SHARD, 4, 0):
        monkeypatch.setattr(substring, "SHARD", shard)
        assert sorted(map(tuple, substring.remove_repeats(df).collect())) == plain_cut(rows, 50)
    chats = spark.createDataFrame([("a", 0, "user", "x"), ("a", 1, "assistant", "y"), (None, 0, "user", "z")], "conv_id string, turn int, role string, text string")
    assert {(r.conv_id, r.n_turns) for r in chat.digests(chat.formatted(chats)).collect()} == {("a", 2), (None, 1)}


def test_written_tables_can_be_cleared(spark, tmp_path):
    from medloom.llm import shared

    path = shared.stage(spark.range(3), "x").inputFiles()[0]
    shared.clear(spark)
    assert not shared._written and not os.path.exists(path.removeprefix("file://"))


def test_the_pipeline_leaves_its_last_table_only(spark):
    from medloom.llm import shared

    own = shared.stage(spark.range(3), "own")
    before = shared.written()
    out = corpus_pipeline.run(spark, SF)
    assert len(shared.written() - before) == 1 and out.count() > 0 and own.count() == 3
    shared.dropped(own)
    assert not before <= shared.written()


def test_substring_odd_rows(odd):
    got = sorted(map(tuple, substring.remove_repeats(odd).collect()), key=repr)
    assert got == plain_cut([(x.doc_id, x.text) for x in odd.collect()], 50)
    assert substring.remove_repeats(odd.limit(0)).count() == 0


def test_automaton_matching_statistics():
    text, other = "abcabxabcd", "zabcabcdx"
    a = substring.Automaton()
    a.add(text)
    covered = {i for x, y in a.spans(other, 3) for i in range(x, y)}
    assert covered == {i + k for i in range(len(other) - 2) if other[i : i + 3] in text for k in range(3)}


def test_warc_round_trip_equals_sql(spark):
    con = duckdb.connect()
    con.sql("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    rows = [(5, "http://a/ü?x=1\r\nX: y", "same"), (3, None, "same"), (9, "u", None), (4, "u", ""), (7, "u", "WARC/1.1\r\n\r\n" * 3), (8, "", "é\U0001f600" * 1000), (2, "u", "same")]
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = warc.round_trip(df)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({warc.ORACLE})").fetchall()
    assert sorted(map(tuple, out.select(*columns).collect())) == sorted(want)
    assert {r.page_id: bytes(r.payload).decode() for r in out.where("record_type = 'response'").collect()}[8] == "é\U0001f600" * 1000
    twice = warc.round_trip(df.union(df).union(spark.createDataFrame([(None, "u", "same")], df.schema)))
    assert twice.count() == 15 and warc.round_trip(df.limit(0)).count() == 0


def test_warc_reads_long_urls(spark):
    rows = [(1, "http://a/" + "x" * (1 << 20), "one"), (2, "http://b/" + "é" * (1 << 19), "two"), (3, "u", "three")]
    out = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in out) == [(i, html) for i, _, html in rows]


def test_salvage_goes_on_after_damage():
    records = [warc.record(i, "u", f"page {i} ".encode() * 50, warc.digest(f"page {i} ".encode() * 50)) for i in range(6)]
    whole = b"".join(records)
    got, gaps = warc.read_archive(whole)
    assert len(got) == 6 and not gaps
    starts = np.cumsum([0, *map(len, records)])
    for k in range(6):
        broken = bytearray(whole)
        for at in range(starts[k] + 20, starts[k] + 40):
            broken[at] ^= 0xFF
        got, gaps = warc.read_archive(bytes(broken))
        assert [r.headers["warc-record-id"] for r in got] == [f"<urn:page:{i}>" for i in range(6) if i != k]
        assert [(g.begin, g.end) for g in gaps] == [(starts[k], starts[k + 1])]
    got, gaps = warc.read_archive(whole[:-30])
    assert len(got) == 5 and [(g.begin, g.end) for g in gaps] == [(starts[5], len(whole) - 30)]
    import zlib

    plain = b"".join(zlib.decompress(r, 31) for r in records)
    cut = plain.replace(b"page 2 page 2", b"page 2 PAGE 2", 1)
    got, gaps = warc.read_archive(b"junk" + cut)
    assert len(got) == 5 and [g.begin for g in gaps][0] == 0 and len(gaps) == 2
    assert warc.read_archive(b"") == ([], []) and warc.read_archive(b"xx")[1][0].end == 2


def test_reader_is_linear_in_the_archive():
    payload = np.random.default_rng(0).bytes(1500)
    one = warc.record(1, "u", payload, warc.digest(payload))

    def took(data):
        begin = time.process_time()
        warc.read_archive(data)
        return time.process_time() - begin

    took(one * 100)
    assert min(took(one * 12_000) for _ in range(2)) < 2.5 * max(took(one * 6_000) for _ in range(2))
    junk = b"".join(one[:20] + b"x" + one[21:] for _ in range(3_000))  # every member is broken
    assert took(junk * 2) < 3 * max(0.05, took(junk))


@pytest.mark.parametrize("known", [warc.KNOWN, 2])
def test_copies_are_spread_over_files(spark, tmp_path, known):
    rows = [(None, None, "the same") for _ in range(400)] + [(None, "u", f"page {i}") for i in range(400)] + [(7, "u", "seven")] * 300 + [(100 + i, "u", f"few {i % 9}") for i in range(60)]
    rows = [rows[i] for i in np.random.default_rng(1).permutation(len(rows))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8)
    warc.write_archives(df, str(tmp_path / "w"), known=known)
    sizes = sorted(f.stat().st_size for f in (tmp_path / "w").glob("part-*"))
    assert len(sizes) >= 8 and sizes[-1] < 3 * sizes[0]
    out = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert len(out) == len(rows) and sum(r.record_type == "revisit" for r in out) == 51
    assert {r.refers_to for r in out if r.record_type == "revisit"} == set(range(100, 109))


def test_revisits_lose_their_html_before_a_shuffle(spark):
    rows = [(i, "u", f"page {i}") for i in range(4000)] + [(10_000 + i, "u", "x" * 5000) for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    plan = warc.with_roles(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    for known in (warc.KNOWN, 0):
        got = warc.with_roles(df, known=known).where("first is not null").collect()
        assert [(r.first, r.html, r.size) for r in got] == [(10_000, None, 5000)] * 3


def test_page_ids_of_any_type(spark):
    rows = [("a<b>/é", "u", "same"), ("b", "u", "same"), (None, "u", "same"), ("", "u", "other"), ("None", None, None)]
    out = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.round_trip(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()}
    assert out == {("a<b>/é", "response", None, 4), ("b", "revisit", "a<b>/é", 4), (None, "revisit", "a<b>/é", 4), ("", "response", None, 5), ("None", "response", None, 0)}


def test_quarantine_log(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(b"noise" + warc.record(1, "u", b"x", warc.digest(b"x")))
    log = warc.quarantined(spark, str(tmp_path)).collect()
    assert [(r.begin, r.end) for r in log] == [(0, 5)] and warc.read_archives(spark, str(tmp_path)).first().page_id == 1


def plain_statistics(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(grams)
    again = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again)


def test_rules_statistics_equal_plain(spark, odd, labels):
    texts = ["a b c a b c d", "x\nx\n x\n\n \nx", "# * $ % & | < >", "é\U0001f600 " * 60, *[r[1] for r in odd_rows()]]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for r in rules.judge(df, labels).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_statistics(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert rules.judge(odd, labels).count() == odd.count() and rules.judge(odd.limit(0), labels).count() == 0


def test_cutoffs_hold_their_bound(spark):
    n = 4000
    rows = [(i, prose(60, i) + (" ###" * 30 if i >= n else ""), "en") for i in range(n + 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, 1) for i in range(n)], "doc_id long, quality int")
    out = {r.doc_id: r.kept for r in rules.judge(df, marks).collect()}
    assert not any(out[i] for i in range(n, n + 50)) and sum(not out[i] for i in range(n)) <= 0.02 * n
    few = marks.limit(100)
    assert all(r.kept for r in rules.judge(df, few).collect())


def test_binomial_tail():
    from math import comb

    for k, n, p in [(0, 10, 0.1), (3, 20, 0.2), (5, 5, 0.3), (40, 1000, 0.05)]:
        assert rules.lower_tail(k, n, p) == pytest.approx(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality", "near_duplicates", "decontamination", "personal_data", "mixture"]
    good = docs.join(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"), "doc_id").where("n_chars > 800").orderBy("doc_id").limit(3).collect()
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    row = lambda i, text, like: (i, text, like.lang, like.source, len(text))
    back = lambda text: " ".join(reversed(text.split()))  # noqa: E731  (another document of the same kind)
    copy, leak, said = row(900_001, good[0].text, good[0]), row(900_002, f"{back(good[1].text)} {item}", good[1]), row(900_003, f"{back(good[2].text)} write to some.one@mail.example now", good[2])
    d = docs.unionByName(spark.createDataFrame([copy, leak, said], docs.schema))
    bad = {r.doc_id for r in docs.join(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0"), "doc_id").collect()}
    kept = {}
    for name in list(steps)[:-1]:
        out = steps[name](spark, d, SF).cache()
        assert out.columns == docs.columns
        kept[name] = {r.doc_id: r.text for r in out.collect()}
        d = spark.createDataFrame(out.collect(), docs.schema)
    assert len(bad & kept["quality"].keys()) <= 0.05 * len(bad) and 900_002 in kept["quality"]
    assert 900_001 not in kept["near_duplicates"] and {900_002, 900_003} <= kept["near_duplicates"].keys()
    assert 900_002 not in kept["decontamination"] and 900_003 in kept["decontamination"]
    assert "[EMAIL]" in kept["personal_data"][900_003] and "some.one" not in kept["personal_data"][900_003]
    assert kept["personal_data"].keys() == kept["decontamination"].keys()
    mixed = steps["mixture"](spark, d, SF).collect()
    assert all(r.copies > 0 for r in mixed) and len(mixed) < len(kept["personal_data"])


def test_pipeline_runs_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert 0 < len(ids) < docs.count() and len(set(ids)) == len(ids)
    assert out.columns[: len(docs.columns)] == docs.columns


def test_pipeline_stages_on_odd_rows(spark, odd):
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, odd, SF)
        assert out.count() <= odd.count() and step(spark, odd.limit(0), SF).count() == 0
        assert name == "mixture" or out.columns == odd.columns
