"""Operators on small tables made for their corner cases."""

import datetime
import hashlib
import hmac

import numpy as np
import pytest
from pyspark.sql import functions as F

from medloom.functions import quantiles
from medloom.functions.dates import complete_months
from medloom.operators import disclosure, explore, policy, pooling, privacy, survival, temporal, verbs, vocabulary
from medloom.sources.tables import read, read_staged, shared_root, write_staged
from medloom.streaming.events import sessions, window_counts

D = datetime.date


def test_complete_months(spark):
    rows = [(D(2024, 1, 30), D(2024, 2, 29), 0), (D(2024, 1, 29), D(2024, 2, 29), 1), (D(2023, 12, 15), D(2024, 12, 15), 12)]
    df = spark.createDataFrame(rows, "a date, b date, n int")
    assert all(r.n == r.m for r in df.withColumn("m", complete_months(F.col("a"), F.col("b"))).collect())


def test_min_gap_chains_by_the_event_before(spark):
    days = [D(2024, 1, 1), D(2024, 1, 8), D(2024, 1, 15), D(2024, 2, 1)]
    df = spark.createDataFrame([(1, d, i) for i, d in enumerate(days)], "person_id int, d date, k int")
    assert [r.k for r in temporal.min_gap(df, ["person_id"], "d", "k", 7).orderBy("k").collect()] == [0, 3]
    assert [r.k for r in temporal.min_gap(df, ["person_id"], "d", "k", 7, "last").orderBy("k").collect()] == [2, 3]


def test_bins_clip_the_last():
    assert temporal.bins(-10, 10, 8) == [(0, -10, -3), (1, -2, 5), (2, 6, 10)]


def test_strict_counts_are_null_where_a_site_lacks_a_value(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("a", "y", 3), ("b", "y", None)], "site string, key string, n int")
    assert {r.key: r.n for r in pooling.counts(df, ["key"], ["n"], 2, site="site").collect()} == {"x": 3, "y": None}
    assert {r.key: r.n for r in pooling.counts(df, ["key"], ["n"], 2, strict=False, site="site").collect()} == {"x": 3, "y": 3}


def test_a_site_that_repeats_a_key_does_not_stand_for_another(spark):
    df = spark.createDataFrame([("a", "x", 1, 0.0, 1.0, 0), ("a", "x", 2, 0.0, 1.0, 0)], "site_id string, key string, n int, bin_start double, bin_end double, bin int")
    for make in (lambda: pooling.counts(df, ["key"], ["n"], 2), lambda: pooling.counts(df, ["key"], ["n"], 2, strict=False), lambda: pooling.top(df, "key", "n", 2, 5), lambda: pooling.tabular(df, ["key"], {"n": ("sum", "n")}, 2), lambda: pooling.histogram(df, 2)):
        with pytest.raises(Exception, match="several rows"):
            make().collect()
    edges = spark.createDataFrame([("a", 0, 0.0, 1.0, 3), ("b", 0, 5.0, 9.0, 4)], "site_id string, bin int, bin_start double, bin_end double, n int")
    with pytest.raises(Exception, match="different edges"):
        pooling.histogram(edges, 2).collect()
    assert [r.n for r in pooling.histogram(edges, 2, strict=False).collect()] == [3]


def test_pooled_variance_of_large_means(spark):
    rows = [("a", 1e9 + i) for i in range(7)] + [("b", 1e9 + i * i) for i in range(5)]
    df = spark.createDataFrame(rows, "site string, v double")
    by = df.groupBy("site").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.var_samp("v").alias("variance"))
    assert pooling.moments(by, [], site="site").first().variance == pytest.approx(df.agg(F.var_samp("v").alias("s")).first().s)


def test_wide_refuses_several_values(spark):
    df = spark.createDataFrame([(1, 7, 1.0), (1, 7, 2.0), (2, 7, 3.0)], "p int, c int, v double")
    with pytest.raises(Exception, match="several rows"):
        temporal.wide(df, ["p"], "c", [7], "v").collect()
    assert temporal.wide(df.where("v > 1"), ["p"], "c", [7], "v").count() == 2


def test_quantiles_equal_those_of_numpy(spark, monkeypatch):
    for n, accuracy in ((4000, 100), (3, 10_000), (500, 10_000)):
        monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
        x, k = np.random.default_rng(n).normal(0, 1, n).round(2), np.arange(n) % 3
        df = spark.createDataFrame([(int(a) or None, float(b)) for a, b in zip(k, x, strict=True)] + [(9, None)], "k int, x double")
        probs = (0, 0.05, 0.333, 0.5, 0.95, 1)
        assert quantiles.exact(df, "x", probs).first().q == pytest.approx(np.quantile(x, probs).tolist())
        got = {r.k or 0: r.q for r in quantiles.exact(df, "x", probs, ["k"]).collect()}
        assert got == {a: pytest.approx(np.quantile(x[k == a], probs).tolist()) for a in range(3)}
    assert quantiles.exact(df.where("false"), "x", (0.5,)).first().q == [None]


def test_shared_folder_is_never_local_on_a_cluster():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, other=None: other)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda key: None)}))

    with pytest.raises(ValueError):
        shared_root(Session)
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError):
        shared_root(Session)


def test_pooled_moments_equal_those_of_all_rows(spark):
    rows = [("a", float(i)) for i in range(7)] + [("b", float(i * i)) for i in range(5)]
    df = spark.createDataFrame(rows, "site string, v double").withColumn("k", F.lit(1))
    by = df.groupBy("site", "k").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.var_samp("v").alias("variance"))
    got, want = pooling.moments(by, ["k"], site="site").first(), df.agg(F.avg("v").alias("m"), F.var_samp("v").alias("s")).first()
    assert got.mean == pytest.approx(want.m) and got.variance == pytest.approx(want.s)


def test_keyed_is_hmac(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("é", None)], "s string, n int")
    for secret in (b"s", b"x" * 64, b"y" * 100):
        for r in df.withColumn("h", privacy.keyed(secret, F.lit("q"), F.col("s"), F.col("n"))).collect():
            said = "1:q" + ("-" if r.s is None else f"1:{r.s}") + ("-" if r.n is None else f"1:{r.n}")
            assert r.h == hmac.new(secret, said.encode(), hashlib.sha256).hexdigest()


def test_noise_depends_on_secret_identity_and_cell_alone(spark):
    cells = spark.range(20_000).select(F.col("id").alias("k"), F.lit(7).cast("long").alias("n"))
    made = lambda secret=b"s", identity="q", e=0.5: {r.k: r.n - 7 for r in privacy.release(cells.repartition(5), ["k"], {"n": 1}, secret, identity, e).collect()}
    first = made()
    assert first == made() and first != made(identity="r") and first != made(secret=b"t")
    draws = np.array(list(first.values()))
    alpha = np.exp(-0.5)
    assert abs(draws.mean()) < 0.1 and abs(draws.var() / (2 * alpha / (1 - alpha) ** 2) - 1) < 0.05
    assert abs((draws == 0).mean() - (1 - alpha) / (1 + alpha)) < 0.02
    assert set(made(e=1e9).values()) == {0}
    two = privacy.release(cells.withColumn("m", F.col("n")), ["k"], {"n": 1, "m": 1}, b"s", "q", 0.5).select((F.col("n") - 7).alias("n"), (F.col("m") - 7).alias("m")).toPandas()
    assert two.n.var() > 3 * draws.var() and abs(two.corr().iloc[0, 1]) < 0.05


def test_state_graphs_in_three_forms():
    states, edges = ["index", "ill", "dead"], [("index", "ill"), ("index", "dead"), ("ill", "dead")]
    forms = [edges, {"index": ["ill", "dead"], "ill": ["dead"], "dead": None}, {"index": [2, 3], "ill": ["3"]}, [[None, 1, 2], [None, None, 3], [None, None, None]]]
    assert all(survival.state_graph(states, f) == (states, edges) for f in forms)
    wrong = [[], [("index", "index")], [("index", "ill")], [("ill", "dead"), ("dead", "ill")], [*edges, edges[0]], [*edges, ("ill", "gone")], [[None, 1], [None, None]], [[None, 1, 1], [None, None, 3], [None] * 3], [[None, 1, 3], [None, None, 4], [None] * 3], {"index": [2, 4]}]
    for f in wrong:
        with pytest.raises(ValueError):
            survival.state_graph(states, f)
    for names in (["index"], ["index", "Index"], ["index", "a b"]):
        with pytest.raises(ValueError):
            survival.state_graph(names, [("index", names[-1])])


def test_the_earliest_death_counts_once(spark):
    cohort = spark.createDataFrame([(1, 1, D(2024, 1, 1), D(2024, 12, 31), D(2024, 12, 31))], "subject_id int, episode_id int, cohort_start_date date, cohort_end_date date, obs_end date")
    death = spark.createDataFrame([(1, D(2024, 3, 1)), (1, D(2024, 2, 1))], "person_id int, death_date date")
    assert [r.exit_day for r in survival.censored(cohort, death=death).collect()] == [31]


def test_closure_of_a_cycle_and_no_rows(spark):
    rows = spark.createDataFrame([(1, 2, "Is a"), (2, 3, "Is a"), (3, 1, "Is a"), (3, 3, "Is a"), (None, 1, "Is a"), (9, 1, "Maps to")], "concept_id_1 int, concept_id_2 int, relationship_id string")
    assert sorted(tuple(r) for r in vocabulary.closure(rows, own=False).collect()) == [(1, 2, 2), (1, 3, 1), (2, 1, 1), (2, 3, 2), (3, 1, 2), (3, 2, 1)]
    assert vocabulary.closure(rows.limit(0)).count() == 0


def test_predicates_and_merge_guard(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "a int, b int")
    tree = {"or": [{"var": "b", "op": "is_null"}, {"and": [{"var": "b", "op": ">", "value": 6}, {"var": "a", "op": "in", "value": [3]}]}]}
    assert sorted(r.a for r in verbs.where(df, tree).collect()) == [2, 3]
    with pytest.raises(ValueError):
        verbs.predicate({"and": []})
    with pytest.raises(ValueError):
        verbs.merge(df, df.union(df), ["a"])


def test_staged_results_come_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    run = write_staged({"one": df}, str(tmp_path))
    assert read_staged(spark, run)["one"].collect() == df.collect()


def test_staged_results_expire_and_have_a_version(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert read_staged(spark, write_staged({"one": df}, str(tmp_path), keep_days=1))["one"].count() == 1
    with pytest.raises(ValueError, match="expired"):
        read_staged(spark, write_staged({"one": df}, str(tmp_path), keep_days=-1))
    with pytest.raises(ValueError, match="outputs"):
        write_staged({str(i): df for i in range(101)}, str(tmp_path))
    spark.createDataFrame([("one", "x", "", 1)], "name string, path string, fields string, version int").write.json(str(tmp_path / "old" / "manifest"))
    with pytest.raises(ValueError, match="version"):
        read_staged(spark, str(tmp_path / "old"))


@pytest.mark.parametrize("form", ["csv", "orc", "json", "parquet"])
def test_sources_of_other_forms(spark, tmp_path, form):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    options = {"header": "true", "inferSchema": "true"} if form == "csv" else {}
    df.write.format(form).options(**{k: v for k, v in options.items() if k == "header"}).save(str(tmp_path / form))
    out = read(spark, str(tmp_path / form), form, ["b", "a"], **options)
    assert out.columns == ["b", "a"] and set(map(tuple, out.collect())) == {("x", 1), (None, 2)}


def test_gate_holds_back_results_of_few_persons(spark):
    rows = spark.createDataFrame([(1, 5), (2, 5)], "person_id int, v int")
    result = rows.agg(F.count("*").alias("n"))
    assert disclosure.gated(rows, result, disclosure.Settings()).count() == 0
    assert disclosure.gated(rows, result, disclosure.Settings(least_persons=2)).count() == 1
    with pytest.raises(ValueError):
        disclosure.checked(rows, disclosure.Settings(most_columns=1))


def test_sessions_close_after_a_gap(spark):
    t = lambda h, m: datetime.datetime(2024, 1, 1, h, m)
    df = spark.createDataFrame([("a", t(1, 0)), ("a", t(1, 20)), ("a", t(1, 55)), ("b", t(1, 0))], "k string, ts timestamp")
    assert sorted((r.k, r.n) for r in sessions(df, "ts", "k").collect()) == [("a", 1), ("a", 2), ("b", 1)]


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = window_counts(stream, "ts", "event_type").writeStream.format("memory").queryName("counts").outputMode("complete").start()
    try:
        q.processAllAvailable()
        got = sorted(map(tuple, spark.table("counts").collect()))
    finally:
        q.stop()
    assert got == sorted(map(tuple, window_counts(events, "ts", "event_type").collect()))


def test_policies_that_sites_agree_on(spark):
    rows = [("a", "most_bins", 10.0), ("b", "most_bins", 7.0), ("a", "least_in_cell", 3.0), ("b", "least_in_cell", 5.0), ("a", "band", 5.0), ("b", "band", 10.0), ("a", "most_levels", 4.0)]
    got = {r.setting: r.value for r in policy.agreed(spark.createDataFrame(rows, "site_id string, setting string, value double"), 2).collect()}
    assert got == {"most_bins": 7.0, "least_in_cell": 5.0, "band": None, "most_levels": None}
    grids = spark.createDataFrame([("a", x) for x in (0, 10, 20, 30)] + [("b", x) for x in (0, 5, 20)] + [("b", 20)], "site_id string, age_from int")
    assert [tuple(r) for r in policy.common_grid(grids, 2).orderBy("age_from").collect()] == [(0, 20), (20, None)]
    with pytest.raises(Exception, match="begin at 0"):
        policy.common_grid(grids.where("age_from > 0"), 2).collect()


def test_quantiles_put_few_values_in_order(spark):
    """Ten million different values: what a window task gets stays small."""
    n, probs = 10_000_000, (0.05, 0.5, 0.95)
    df = spark.range(n).select((F.col("id") * 7_654_321 % n).cast("double").alias("v"))  # every number below n, once
    assert quantiles.exact(df, "v", probs).first().q == pytest.approx([p * (n - 1) for p in probs])
    within = 8 / quantiles.ACCURACY * 10_000_000
    assert 2 * within / quantiles.CELLS < 100_000 and within < 100_000


@pytest.mark.parametrize("n", [1, 2, 3, 50, 30_000])
def test_quantiles_of_ties_and_cells(spark, n, monkeypatch):
    monkeypatch.setattr(quantiles, "ACCURACY", 100)
    monkeypatch.setattr(quantiles, "CELLS", 4)
    rng = np.random.default_rng(n)
    v = rng.choice([0.0, 1.5, 1.5, -3.0, *rng.normal(0, 9, 20).tolist()], n) if n % 2 else rng.normal(0, 1, n)
    df = spark.createDataFrame([("a" if i % 3 else None, float(x)) for i, x in enumerate(v)], "k string, v double")
    probs = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)
    assert quantiles.exact(df, "v", probs).first().q == pytest.approx(np.quantile(v, probs).tolist())
    for r in quantiles.exact(df, "v", probs, ["k"]).collect():
        own = [x for i, x in enumerate(v) if (i % 3 == 0) == (r.k is None)]
        assert r.q == pytest.approx(np.quantile(own, probs).tolist())


@pytest.mark.parametrize("kind", ["long", "int", "string", "decimal(20,0)"])
def test_prevalence_of_persons_by_any_id(spark, kind):
    """Persons of a word's ends, below 0, twice, in two tables, none; concepts in both tables, none."""
    big = 2**31 - 1
    a = [(7, p) for p in (0, 63, 64, -1, -64, -65, big, -big - 1, 63, None)] + [(None, 1), (8, None), (8, None)]
    b = [(7, 63), (7, 65), (9, 5), (9, 5), (None, 1), (None, 2)]
    tables = {n: (spark.createDataFrame(rows, "c long, p long").select(F.col("c").alias(f"c_{n}"), F.col("p").cast(kind).alias("person_id")), f"c_{n}") for n, rows in (("a", a), ("b", b))}
    plain = lambda rows: {c: (len({p for d, p in rows if d == c and p is not None}), sum(d == c for d, _ in rows)) for c in {c for c, _ in rows}}
    got = lambda df: {r.concept_id: (r.n_persons, r.n_records) for r in df.collect()}
    assert got(explore.prevalence_of_all(tables, least_persons=0)) == plain(a + b)
    assert got(explore.prevalence(*tables["a"], least_persons=0)) == plain(a)
    assert got(explore.prevalence_of_all(tables, least_persons=3)) == {7: plain(a + b)[7]}


def test_prevalence_of_tables_whose_ids_differ_in_kind(spark):
    a, b = spark.createDataFrame([(1, 5), (1, 6)], "c int, person_id int"), spark.createDataFrame([(1, "5"), (1, "7")], "c long, person_id string")
    b = b.withColumn("person_id", F.col("person_id").cast("decimal(12,0)"))
    assert [tuple(r) for r in explore.prevalence_of_all({"a": (a, "c"), "b": (b, "c")}).collect()] == [(1, 3, 4)]


def _shuffled(plan) -> int:
    """Rows that the exchanges of an executed plan wrote."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _shuffled(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _shuffled(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(_shuffled(plan.children().apply(i)) for i in range(plan.children().size()))


def test_prevalence_holds_a_row_for_64_persons(spark):
    """Not one for each concept and person: 64,000 of them here."""
    rows = spark.range(0, 64_000, 1, 4).select((F.col("id") % 2).alias("c"), F.floor(F.col("id") / 2).alias("person_id"))
    for df, n in ((explore.prevalence(rows, "c"), 1), (explore.prevalence_of_all({"a": (rows, "c"), "b": (rows, "c")}), 2)):
        assert [tuple(r) for r in df.collect()] == [(c, 32_000, n * 32_000) for c in (0, 1)]
        assert 1_000 <= _shuffled(df._jdf.queryExecution().executedPlan()) < 5_000


def test_read_over_jdbc(spark, tmp_path):
    url = f"jdbc:derby:memory:{tmp_path.name};create=true"
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    rows = [(1, "a", D(2024, 1, 1)), (2, None, None)]
    spark.createDataFrame(rows, "id int, name string, d date").write.format("jdbc").options(url=url, dbtable="person", driver=driver).save()
    got = read(spark, "person", "jdbc", ["id", "d"], url=url, driver=driver)
    assert sorted(tuple(r) for r in got.collect()) == [(1, D(2024, 1, 1)), (2, None)] and got.columns == ["id", "d"]
    assert read(spark, '(select "id" from person where "id" > 1) x', "jdbc", url=url, driver=driver).count() == 1
