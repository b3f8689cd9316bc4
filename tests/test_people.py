"""Vocabulary, persons, results and schemas on small tables made for their corner cases."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.operators import people, pooling, privacy, results, vocabulary
from medloom.sources import schemas


def test_snapping_to_public_edges():
    edges = [0.0, 10.0, 20.0, 30.0]
    assert people.snap(edges, 12) == (10.0, 30.0) and people.snap(edges, 12, "below") == (0.0, 10.0)
    assert people.snap(edges, -5) == (0.0, 30.0) and people.snap(edges, 99) == (20.0, 30.0)
    assert people.snap_outwards(edges, 11, 19) == (10.0, 20.0) and people.snap_outwards(edges, -4, 40) == (0.0, 30.0)
    with pytest.raises(ValueError):
        people.snap([1.0], 1)


def test_score_takes_the_largest_weight_of_a_category(spark):
    persons = spark.createDataFrame([(1, 80), (2, 30), (3, 30)], "person_id int, age int")
    events = spark.createDataFrame([(1, 11), (1, 12), (1, 11), (2, 21), (2, 99)], "person_id int, c int")
    own = spark.createDataFrame([("a", 11, 1), ("a", 12, 3), ("b", 20, 2)], "category string, concept_id int, weight int")
    below = spark.createDataFrame([(20, 21), (20, 20)], "ancestor_concept_id int, descendant_concept_id int")
    got = people.score(persons, events, "c", people.codes(own, below), F.when(F.col("age") >= 75, 1).otherwise(0))
    assert {r.person_id: r.score for r in got.collect()} == {1: 4, 2: 2, 3: 0}


def test_reference_in_no_or_two_periods_gives_null(spark):
    rows = [(1, "2020-01-01", "2020-12-31"), (2, "2020-01-01", "2020-12-31"), (2, "2020-06-01", "2021-06-01"), (3, "2019-01-01", "2019-02-01")]
    d = ["observation_period_start_date", "observation_period_end_date"]
    p = spark.createDataFrame(rows, f"person_id int, {d[0]} string, {d[1]} string").withColumns({c: F.to_date(c) for c in d})
    got = people.around_reference(p.select("person_id").distinct(), p, F.lit("2020-07-01").cast("date"))
    assert {r.person_id: (r.prior_obs, r.followup) for r in got.collect()} == {1: (182, 183), 2: (None, None), 3: (None, None)}


def test_missing_demographics_count_null_and_zero(spark):
    df = spark.createDataFrame([(0, None, 3)], "a int, b int, c int")
    assert df.select(people.demographic_missingness(["a", "b", "c"]).alias("n")).first().n == 2


def test_expand_maps_and_excludes(spark):
    a = spark.createDataFrame([(1, 2)], "ancestor_concept_id int, descendant_concept_id int")
    r = spark.createDataFrame([(90, 2, "Maps to"), (91, 2, "Is a"), (92, 1, "Maps to")], "concept_id_1 int, concept_id_2 int, relationship_id string")
    assert sorted(x.concept_id for x in vocabulary.expand([1], a, r, True, True, [92]).collect()) == [1, 2, 90]
    assert [x.concept_id for x in vocabulary.expand([1], a).collect()] == [1]


def test_levels_are_left_out_beyond_their_bound(spark):
    df = spark.createDataFrame([(10,), (2,), (None,), (2,)], "v int")
    assert [(r.level, r.code) for r in vocabulary.levels(df, "v").orderBy("code").collect()] == [(2, 1), (10, 2)]
    assert vocabulary.levels(df, "v", 1).collect() == []


def test_tabular_roles(spark):
    rows = [("a", "x", 2, 10.0, 1.0, "l"), ("b", "x", 3, 20.0, 2.0, "m"), ("a", "y", 1, 5.0, None, "l")]
    df = spark.createDataFrame(rows, "site string, k string, n int, m double, sd double, label string")
    roles = {"mean": ("weighted_mean", "m", "n"), "sd": ("pooled_sd", "n", "m", "sd"), "label": ("label", "label")}
    (x,) = pooling.tabular(df, ["k"], roles, 2, site="site").collect()
    assert x.k == "x" and x.mean == pytest.approx(16) and x.label is None
    assert x.sd == pytest.approx(((1 * 1 + 2 * 4 + 2 * 36 + 3 * 16) / 4) ** 0.5)
    assert pooling.tabular(df, ["k"], roles, 2, strict=False, site="site").count() == 2


def test_pooled_curve_ends_where_a_site_is_missing(spark):
    rows = [("a", 1, 10, 1), ("b", 1, 10, 3), ("a", 2, 9, 1), ("a", 3, 8, 1), ("b", 3, 6, 1)]
    df = spark.createDataFrame(rows, "site string, time int, at_risk int, events int").withColumn("k", F.lit(1))
    (only,) = pooling.survival_curves(df, ["k"], 2, site="site").collect()
    assert (only.time, only.survival) == (1, pytest.approx(0.8))


def test_numeric_release_closes_the_last_bin(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 10.0), (3, 20.0), (4, 20.1), (5, None)], "person_id int, v double")
    assert [r.n for r in privacy.numeric(df, "v", [0, 10, 20]).orderBy("bin").collect()] == [1, 2]


def test_site_rows_share_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(1, 3)], "x int, z int")
    assert sorted(map(tuple, results.by_site({"a": a, "b": b}).collect())) == [("a", 1), ("b", 1)]
    assert results.union_of_sites([a, b]).count() == 1


def test_schemas_are_compared_by_family():
    s = lambda **c: T.StructType([T.StructField(k, v) for k, v in c.items()])
    sites = {"a": {"t": s(x=T.IntegerType(), y=T.StringType()), "u": s(x=T.IntegerType())}, "b": {"t": s(x=T.DoubleType(), y=T.DateType(), z=T.LongType())}}
    got = schemas.compare(sites)
    assert got["common"] == {"t": ["x"]} and got["only"] == {"a": ["u"], "b": []}
    assert got["mismatches"] == [("t", "y", {"a": "character", "b": "temporal"})]
