"""Periodic runs, URL filters and vector codes: brute force, SQL and odd rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import differences

from medloom.llm import codes, periodic, registry, urls

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] == w[i + q]:
                j = i
                while j + q < n and w[j] == w[j + q]:
                    j += 1
                size = j - i + q
                part = w[i : i + size]
                if size >= max(6, 4 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                    out.append((i, size, q))
                i = j
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def looped(rng, n, letters):
    w = rng.integers(0, letters, n)
    for _ in range(rng.integers(0, 4)):
        if n > 20:
            a, q = int(rng.integers(0, n - 10)), int(rng.integers(1, 30))
            for i in range(a + q, min(n, a + int(q * rng.integers(3, 8)) + int(rng.integers(0, 3)))):
                w[i] = w[i - q]
    return w


def test_runs_equal_brute_force_at_all_lags_and_at_repeating_ones():
    rng, total = np.random.default_rng(5), 0
    for _ in range(500):
        w = looped(rng, int(rng.integers(0, 260)), int(rng.integers(1, 4)))
        want = plain_runs(w.tolist())
        total += len(want)
        assert periodic.word_runs(w, 1 << 30) == want and periodic.word_runs(w, 0) == want
    assert total > 500


@pytest.mark.parametrize("w", [np.zeros(400_000, int), np.arange(400_000) % 3, np.where(np.arange(400_000) == 150_001, 1, 0)])
def test_runs_of_a_long_loop(w):
    found = periodic.word_runs(w)
    assert len(found) == (2 if w.sum() == 1 else 1) and sum(r[1] for r in found) >= len(w) - 1


def plain_row(doc_id, text):
    w = WORD.findall(text or "")
    if doc_id is not None:
        h, n = zlib.crc32(str(doc_id).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = plain_runs(w)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def columns(df):
    return df.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_periodic_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.length("text") < 6000)
    got = columns(periodic.digests(periodic.find(periodic.with_loops(docs)))).collect()
    want = [plain_row(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, got)) == sorted(want) and sum(r.n_runs for r in got) > 5
    assert registry.queries()["op11_periodic"](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_loops_of_documents_without_words(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    rows = list(zip(ids, [None, "", " \n", "one"], strict=True))
    got = sorted(map(tuple, columns(periodic.digests(periodic.find(periodic.with_loops(spark.createDataFrame(rows, "doc_id long, text string"))))).collect()))
    assert got == [plain_row(*r) for r in rows]


def test_periodic_odd_rows(spark):
    texts = [None, "", " \n\t ", "a", "a " * 5, "a " * 6, "a b " * 4, "a b c a b c a b c a b", "é\U0001f600 " * 9, "x y " * 30_000, "a a a a a a b b b b b b"]
    rows = [(i, t, "s", 1) for i, t in enumerate(texts)] + [(4, "a " * 5, "s", 1), (None, "q " * 7, "s", 1), (10**15, "w " * 40, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int")
    got = sorted(map(tuple, columns(periodic.digests(periodic.find(periodic.with_loops(df)))).collect()), key=repr)
    want = []
    for i, t, *_ in rows:
        if t and len(t) > 10_000:
            continue
        want.append(plain_row(i, t))
    assert [r for r in got if r[0] != 9] == sorted(want, key=repr)
    long = next(r for r in got if r[0] == 9)
    assert long[1] >= 1
    assert periodic.find(df.limit(0)).count() == 0
    by_name = periodic.find(spark.createDataFrame([("x", "a " * 6)], "doc_id string, text string")).first()
    assert by_name.doc_id == "x" and by_name.collapsed == "a" and [tuple(r) for r in by_name.runs] == [(0, 6, 1)]


@pytest.mark.parametrize("name", ["op12_urls", "op13_codes"])
def test_query_equals_sql(spark, name):
    assert differences(registry.queries()[name](spark, SF), registry.oracle_sql()[name], SF) == ""


def judged(spark, found, host_rules=urls.HOST_RULES, patterns=urls.PATTERNS):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(found)], "page_id long, url string, verdict string, token string")
    return {r.page_id: r for r in urls.judge(df, urls.rules_table(spark, host_rules, patterns)).collect()}


def test_host_rules(spark):
    cases = {
        "http://a.NET/x": ("a.net", "/x", "net/", "block"), "http://net": ("net", "", None, "allow"), "http://net/": ("net", "/", "net/", "block"), "http://example.net/en/": ("example.net", "/en/", "example.net/en/", "allow"),
        "http://m.example.net/en/1?q#z": ("m.example.net", "/en/1", "example.net/en/", "allow"), "http://myexample.net/en/": ("myexample.net", "/en/", "net/", "block"), "http://example.net/EN/": ("example.net", "/EN/", "net/", "block"),
        "x://example.com/de/a://b": ("example.com", "/de/a://b", "example.com/de/", "block"), "http://example.com/de": ("example.com", "/de", None, "allow"), "http://a.org?/fr/": ("a.org", "", None, "allow"), "http://a.org/fr/\n2": ("a.org", "/fr/\n2", "org/fr/", "allow"),
        "no scheme.net/": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"), "http://éx.net/é": ("éx.net", "/é", "net/", "block"), "http://": ("", "", None, "allow"), "http://" + "a" * 100_000 + ".net/" + "b" * 100_000: ("a" * 100_000 + ".net", "/" + "b" * 100_000, "net/", "block"),
    }
    got = judged(spark, list(cases), patterns=[])
    for i, (u, want) in enumerate(cases.items()):
        assert tuple(got[i])[1:5] == want, u


def test_patterns_and_their_index(spark):
    patterns = [("||ads.", "block"), ("||ads.*/open/", "allow"), ("/track^", "block"), ("*pixel*", "block"), ("end.gif|", "block"), ("a+b(c)", "block")]
    found = ["http://ads.example.com/", "http://x.ads.example.com/y/open/z", "http://bads.example.com/", "http://a.b/track?x", "http://a.b/tracker", "http://a.b/mypixels", "http://a.b/the-end.gif", "http://a.b/end.gifs", "http://a.b/a+b(c)", "http://a.b/aab(c)"]
    got = judged(spark, found, [], patterns)
    assert [got[i].pattern for i in range(len(found))] == ["||ads.", "||ads.*/open/", None, "/track^", None, "*pixel*", "end.gif|", None, "a+b(c)", None]
    assert [got[i].verdict == "block" for i in range(len(found))] == [True, False, False, True, False, True, True, False, True, False]
    pages = spark.createDataFrame([(u,) for u in ["ads.example.com/", "example.com/x", "ads.x.com/open/"]], "address string")
    rows = {r.rule: r.token for r in urls.index(urls.rules_table(spark, [("example.com/de/", "block"), ("x", "allow")], patterns), pages).collect()}
    assert rows == {"||ads.": "ads", "||ads.*/open/": "open", "/track^": "track", "*pixel*": "", "end.gif|": "gif", "a+b(c)": "b", "example.com/de/": "de", "x": "x"}


def test_urls_equal_trying_every_rule(spark):
    rng = np.random.default_rng(2)
    parts = ["ads", "net", "example", "com", "de", "fr", "x1", "-", ".", "/", "?", "#", "A"]
    found = ["http://" + "".join(rng.choice(parts, rng.integers(1, 9))) for _ in range(800)]
    patterns = [("".join(rng.choice(["||", ""], 1)) + "".join(rng.choice([*parts[:9], "*", "^", "/"], rng.integers(1, 4))) + "".join(rng.choice(["|", ""], 1)), str(rng.choice(["allow", "block"]))) for _ in range(60)]
    patterns = list(dict(patterns).items())
    got = judged(spark, found, [], patterns)
    for i, u in enumerate(found):
        m = re.match(r"(?s)^.*?://([^/?#]*)(.*)$", u)
        address = m[1].lower() + m[2]
        fits = [(v == "allow", len(p), p, v) for p, v in patterns if re.search(urls._plain(p), address)]
        want = max(fits, default=(None, None, None, "allow"))
        assert (got[i].pattern, got[i].verdict) == want[2:], (u, want)


def test_urls_repeated_rows_and_empty_tables(spark):
    rules = urls.rules_table(spark, urls.HOST_RULES, urls.PATTERNS)
    df = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None)], "page_id long, url string")
    assert sorted(r.verdict for r in urls.judge(df, rules).collect()) == ["allow", "block", "block"]
    assert urls.judge(df.limit(0), rules).count() == 0 and urls.judge(df, rules.limit(0)).where("verdict = 'allow'").count() == 3
    assert "Python" not in urls.judge(df, rules)._jdf.queryExecution().toString()


def plain_codes(rows, entries, rounds):
    kept = sorted([(i, v, k) for i, v, k in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)], key=lambda r: (r[0] is None, r[0] or 0, [int(np.floor(1024 * c)) for c in r[1]]))
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) for c in v] for _, v, _ in kept]).reshape(len(kept), 4, -1)
    book = x[:entries].transpose(1, 0, 2).copy()

    def near():
        return ((x[:, :, None, :] - book[None]) ** 2).sum(axis=3).argmin(axis=2)

    for _ in range(rounds):
        c = near()
        for p in range(4):
            for e in range(book.shape[1]):
                own = x[c[:, p] == e, p]
                if len(own):
                    book[p, e] = own.sum(axis=0) // len(own)
    c = near()
    error = ((x - np.stack([book[p][c[:, p]] for p in range(4)], axis=1)) ** 2).sum(axis=(1, 2))
    return [(r[0], "".join(f"{v:02x}" for v in c[i]), int(error[i])) for i, r in enumerate(kept)], book


@pytest.mark.parametrize("levels", [3, 40, 4000])
def test_codes_equal_plain_rounds(spark, levels):
    rng = np.random.default_rng(levels)  # few levels: many ties and repeats
    rows = [(int(i), [float(c) / 64 for c in rng.integers(-levels, levels, 8)], int(rng.integers(0, 3))) for i in rng.permutation(700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found, book = codes.trained(df, 16, 6)
    want, plain_book = plain_codes(rows, 16, 6)
    got = found.collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == sorted(want) and (book == plain_book).all()
    assert sum(r.scans for r in got) < 0.8 * 700 * 4 * 7  # bounds spare scans
    back = {r.vec_id: r.x for r in codes.decoded(found, book).collect()}
    assert all(sum((int(np.floor(1024 * c)) - b) ** 2 for c, b in zip(v, back[i], strict=True)) == dict((w[0], w[2]) for w in want)[i] for i, v, _ in rows[:20])


def test_codes_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, -0.1, 0.2, 0.3], 1), (2, None, 1), (3, [0.1, None, 0.2, 0.3], 1), (4, [nan, 0.0, 0.0, 0.0], 1), (5, [inf, 0.0, 0.0, 0.0], None), (6, [-inf, 0.0, 0.0, 0.0], 2), (7, [1e4, -1e4, 0.0, 0.0], None), (None, [0.1, 0.2, 0.3, 0.4], None), (1, [0.1, -0.1, 0.2, 0.3], 1)]
    df = spark.createDataFrame([(*r, "c", 1.0) for r in rows], "vec_id long, embedding array<float>, label int, code string, x double")
    got = codes.compress(df).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.error, r.label_error) for r in got) == [(False, 1, 0, 0), (False, 1, 0, 0), (False, 7, 0, 0), (True, 0, 0, 0)]
    assert codes.compress(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="one length"):
        codes.compress(spark.createDataFrame([(1, [0.1] * 4, 1), (2, [0.1] * 8, 1)], "vec_id long, embedding array<float>, label int"))
    with pytest.raises(Exception, match="is not below"):
        codes.compress(spark.createDataFrame([(1, [1e30] * 4, 1)], "vec_id long, embedding array<float>, label int"))


def test_codes_of_large_components(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in rng.integers(-32_767, 32_768, 16)], 0) for i in range(60)]  # beyond exact doubles
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = codes.trained(df, 5, 3)[0].collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == sorted(plain_codes(rows, 5, 3)[0])
