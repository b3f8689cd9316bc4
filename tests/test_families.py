"""Eras, pathways, attrition, performance and pooling checks on small tables made for their corner cases."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from medloom.operators import characterise, diagnostics, eras, pathways, performance, pooling

D = datetime.date
START = D(2024, 1, 1)


def day(n):
    return None if n is None else START + datetime.timedelta(days=n)


def spans(rows):
    return sorted((r.k, (r.era_start - START).days, (r.era_end - START).days, r.n_rows, r.gap_days) for r in rows)


def rows_of(spark, rows):
    return spark.createDataFrame([(k, day(a), day(b), n) for k, a, b, n in rows], "k string, a date, b date, n int")


def test_eras_join_what_overlaps_or_touches(spark):
    df = rows_of(spark, [("x", 0, 9, None), ("x", 10, 12, None), ("x", 3, 4, None), ("x", 14, None, None), ("x", 14, 2, None), ("y", 5, 5, None), (None, 7, 8, None), ("x", None, 3, None)])
    got = spans(eras.collapse(df.where("k is not null"), ["k"], "a", "b").collect())
    assert got == [("x", 0, 12, 3, 0), ("x", 14, 14, 2, 0), ("y", 5, 5, 1, 0)]
    assert spans(eras.collapse(df.where("k is not null"), ["k"], "a", "b", 1).collect()) == [("x", 0, 14, 5, 1), ("y", 5, 5, 1, 0)]
    assert eras.collapse(df.where("k is null"), ["k"], "a", "b").count() == 1
    assert eras.collapse(df.limit(0), ["k"], "a", "b").count() == 0


def test_eras_carry_supply_forward(spark):
    df = rows_of(spark, [("x", 0, None, 30), ("x", 20, None, 30), ("x", 62, None, 10), ("x", 80, None, None)])
    assert spans(eras.collapse(df, ["k"], "a", None, 5, "n", carry=True).collect()) == [("x", 0, 71, 3, 2), ("x", 80, 80, 1, 0)]
    assert spans(eras.collapse(df, ["k"], "a", None, 5, "n").collect()) == [("x", 0, 49, 2, 0), ("x", 62, 71, 1, 0), ("x", 80, 80, 1, 0)]


def steps_of(spark, rows, **how):
    cohort = spark.createDataFrame([(1, 1, START)], "subject_id int, episode_id int, cohort_start_date date")
    e = spark.createDataFrame([(1, n, day(a), day(b)) for n, a, b in rows], "subject_id int, name string, era_start date, era_end date")
    found = pathways.steps(cohort, e, "name", 100, **how)
    return [(r.treatment, r.start_day, r.end_day) for r in found.orderBy("step").collect()]


def test_pathways_open_combinations_by_overlap(spark):
    assert steps_of(spark, [("a", 0, 40), ("b", 20, 60), ("c", 30, 70)], overlap=11) == [("a", 0, 19), ("a+b", 20, 29), ("a+b+c", 30, 40), ("b+c", 41, 60), ("c", 61, 70)]
    assert steps_of(spark, [("a", 0, 40), ("b", 20, 60), ("c", 35, 70)], overlap=10) == [("a", 0, 19), ("a+b", 20, 34), ("b+c", 35, 60), ("c", 61, 70)]
    assert steps_of(spark, [("a", 0, 40), ("b", 20, 60)], overlap=30) == [("a", 0, 19), ("b", 20, 60)]
    assert steps_of(spark, [("b", 0, 9), ("a", 0, 9)], overlap=30) == [("a", 0, 9)]  # a tie
    assert steps_of(spark, [("b", 0, 39), ("a", 0, 39)], overlap=30) == [("a+b", 0, 39)]


def test_pathways_merge_and_clip(spark):
    rows = [("a", 0, 9), ("a", 20, 29), ("b", 95, 300), ("c", -3, 50), ("d", 101, 120)]
    assert steps_of(spark, rows, gap=10) == [("a", 0, 29), ("b", 95, 100)]
    assert steps_of(spark, rows, gap=9) == [("a", 0, 9), ("a", 20, 29), ("b", 95, 100)]
    assert steps_of(spark, rows, least=10, gap=9) == [("a", 0, 9), ("a", 20, 29)]
    assert steps_of(spark, [("d", 101, 120)]) == []


def test_path_counts_are_of_prefixes(spark):
    rows = [(1, 1, 1, "a"), (1, 1, 2, "b"), (1, 1, 3, "a"), (2, 1, 1, "a"), (3, 1, 1, "a"), (3, 1, 2, "b")]
    found = spark.createDataFrame(rows, "subject_id int, episode_id int, step int, treatment string")
    assert sorted(tuple(r) for r in pathways.counts(found, 2).collect()) == [("a", 1, 3, 1), ("a>b", 2, 2, 2)]
    assert [r.path for r in pathways.counts(found, 2, 3).collect()] == ["a"]


def test_masks_of_criteria_with_and_without_events(spark):
    cohort = spark.createDataFrame([(i, 1, START, i) for i in range(4)], "subject_id int, episode_id int, cohort_start_date date, age int")
    events = spark.createDataFrame([(0, day(-5), 1), (0, day(3), 2), (1, day(-1), 1), (1, day(-1), 1), (2, day(9), None)], "person_id int, d date, c int")
    c = F.col("c")
    criteria = [diagnostics.Criterion("old", None, F.col("age") >= 1), diagnostics.Criterion("one", "e", c == 1, None, 0), diagnostics.Criterion("none of 2", "e", c == 2, least=0, most=0), diagnostics.Criterion("two of 1", "e", c == 1, least=2)]
    found = diagnostics.masks(cohort, {"e": (events, "d")}, criteria)
    assert {r.subject_id: r["mask"] for r in found.collect()} == {0: 0b0010, 1: 0b1111, 2: 0b0101, 3: 0b0101}
    rows = {r.criterion: tuple(r)[2:] for r in diagnostics.attrition(found, criteria).collect()}
    assert rows == {1: (4, 3, 3, 0, 0), 2: (3, 1, 2, 1, 0), 3: (1, 1, 3, 0, 0), 4: (1, 1, 1, 0, 0)}
    assert [r.subject_id for r in diagnostics.passing(cohort, found, criteria).collect()] == [1]


def test_curve_and_auc_equal_plain_counts(spark):
    rng = np.random.default_rng(4)
    rows = [(g, float(s), int(y)) for g, n in (("a", 900), (None, 300), ("one", 5)) for s, y in zip(rng.integers(0, 200, n) / 7, rng.random(n) < 0.3 if g != "one" else [1] * n, strict=True)]
    df = spark.createDataFrame([*rows, ("a", None, 1), ("a", 1.0, None), ("a", float("nan"), 1)], "g string, s double, y int")
    by = {}
    for g, s, y in rows:
        by.setdefault(g, []).append((s, y))
    got = performance.curve(df, "s", "y", ["g"], 16).collect()
    assert len(got) == sum(len({s for s, _ in v}) for v in by.values())
    for r in got:
        v = by[r.g]
        assert (r.tp, r.fp, r.fn, r.tn) == tuple(sum(s >= r.threshold and y == k for s, y in v) for k in (1, 0)) + tuple(sum(s < r.threshold and y == k for s, y in v) for k in (1, 0))
    for r in performance.auc(df, "s", "y", ["g"]).collect():
        pairs = [(a > b) + (a == b) / 2 for a, p in by[r.g] if p for b, q in by[r.g] if not q]
        assert r.auc == (pytest.approx(np.mean(pairs)) if pairs else None)
    assert performance.auc(df.limit(0), "s", "y").first().auc is None
    at = {(r.g, r.threshold): r.tp for r in performance.at_thresholds(df, "s", "y", [3.0, 99.0], ["g"]).collect()}
    assert at == {(g, t): sum(s >= t and y for s, y in v) for g, v in by.items() for t in (3.0, 99.0)}


def test_curve_puts_no_group_in_one_window(spark):
    plan = performance.curve(spark.range(10).selectExpr("id / 3 as s", "id % 2 as y"), "s", "y")._jdf.queryExecution().toString()
    assert "bucket" in plan


def test_sites_that_come_twice_are_refused(spark):
    df = spark.createDataFrame([("a", 1, 1, 2.0, 1.0), ("a", 1, 1, 3.0, 1.0)], "site_id string, n int, den int, mean double, variance double")
    calls = [lambda: pooling.moments(df, []), lambda: pooling.ratio(df, [], "n", "den"), lambda: pooling.released_rate(df.withColumnRenamed("n", "num")), lambda: pooling.released_mean(df.withColumnRenamed("den", "sum_grid"), 0.0, 1.0)]
    for call in calls:
        with pytest.raises(Exception, match="several rows"):
            call().collect()


def test_ratio_of_several_columns(spark):
    df = spark.createDataFrame([("a", 30, 10), ("b", 20, 20), ("c", None, 5)], "site_id string, tp int, fp int")
    assert pooling.ratio(df, [], "tp", ["tp", "fp"]).first().ratio == 50 / 80
    assert pooling.tabular(df, [], {"ppv": ("ratio", ["tp"], ["tp", "fp"])}, 3).first().ppv == 50 / 80


def test_effects_of_a_site_with_several_estimates(spark):
    rows = [("a", "x", 0.1, 0.2), ("a", "x", 0.1, 0.2), ("b", "x", 0.3, 0.2), ("a", "y", 0.1, 0.2), ("a", "y", 0.2, 0.2), ("b", "y", 0.3, 0.2), ("b", "z", None, 0.1)]
    df = spark.createDataFrame(rows, "site_id string, k string, log_estimate double, se double")
    got = {r.k: r for r in pooling.effects(df.withColumnRenamed("k", "key"), ["key"]).withColumnRenamed("k", "n").withColumnRenamed("key", "k").collect()}
    assert got["x"].n == 2 and got["x"].fixed == pytest.approx(0.2) and got["y"].n is None and got["y"].random is None and "z" not in got
    loose = {r.key: r for r in pooling.effects(df.withColumnRenamed("k", "key"), ["key"], strict=False).collect()}
    assert loose["y"].k == 1 and loose["y"].fixed == pytest.approx(0.3)


def test_effects_of_an_estimate_computed_anew(spark):
    """Means and deviations of the same rows in another order differ in their last digits."""
    rows = [("a", "x", 0.1 + 0.2, 0.2), ("a", "x", 0.3, 0.2), ("a", "s", 0.3, 0.1 + 0.2), ("a", "s", 0.3, 0.3), ("a", "zero", 1e-17, 0.2), ("a", "zero", -1e-17, 0.2), ("a", "y", 0.3, 0.2), ("a", "y", 0.3 + 1e-6, 0.2), ("a", "e", 0.3, 0.2), ("a", "e", 0.3, 0.2 + 1e-6)]
    df = spark.createDataFrame([*rows, *[("b", k, 0.3, 0.2) for k in {r[1] for r in rows}]], "site_id string, key string, log_estimate double, se double")
    assert {r.key: r.k for r in pooling.effects(df, ["key"]).collect()} == {"x": 2, "s": 2, "zero": 2, "y": None, "e": None}


def test_challenges(spark):
    e = spark.createDataFrame([(1, "d", day(0), day(20)), (1, "d", day(60), day(70)), (2, "d", day(0), day(20)), (3, "d", day(0), day(200))], "subject_id int, exposure_id string, era_start date, era_end date")
    o = spark.createDataFrame([(1, "r", day(5)), (1, "r", day(65)), (2, "r", day(20)), (2, "r", day(25)), (3, "r", day(1))], "subject_id int, outcome_id string, outcome_date date")
    got = {(r.subject_id, r.trial): (r.dechallenge, r.rechallenge) for r in eras.challenges(e, o).collect()}
    assert got == {(1, 1): (1, 1), (1, 2): (1, None), (2, 1): (0, None)}
    assert tuple(eras.challenge_counts(eras.challenges(e, o)).first()) == ("d", "r", 3, 2, 2, 1, 1, 1)


def test_person_time_without_days_after_an_outcome(spark):
    spans = [(1, D(2020, 12, 30), D(2021, 1, 5)), (1, D(2021, 1, 3), D(2021, 1, 20)), (2, D(2021, 2, 1), D(2021, 2, 10)), (3, D(2021, 3, 5), D(2021, 3, 1)), (4, D(2021, 4, 1), D(2021, 4, 3))]
    risk = spark.createDataFrame([(*s, "x") for s in spans], "subject_id long, cohort_start_date date, cohort_end_date date, year string")
    found = [(1, D(2020, 12, 31)), (1, D(2020, 12, 31)), (1, D(2021, 1, 8)), (1, D(2021, 1, 16)), (2, D(2021, 1, 30)), (2, D(2021, 2, 4)), (4, D(2021, 3, 31)), (4, None), (9, D(2021, 1, 1))]
    o = spark.createDataFrame([(*r, 1) for r in found], "person_id long, when date, d int")
    rows = lambda clean: sorted(map(tuple, characterise.person_time(risk, o, "when", clean).collect()))
    assert rows(0) == [(1, 2020, 2, 1), (1, 2021, 20, 2), (2, 2021, 10, 1), (4, 2021, 3, 0)]
    # 8 days after each: of person 1 1 to 8 January and 9 to 20 go (8 and 16 January are no new cases), of person 2 1 to 10 February, of person 4 all
    assert rows(8) == [(1, 2020, 2, 1)]
    assert rows(7) == [(1, 2020, 2, 1), (1, 2021, 20 - 7 - 7 - 4, 2)]
    assert characterise.person_time(risk.limit(0), o, "when", 7).count() == 0 and sorted(map(tuple, characterise.person_time(risk, o.limit(0), "when", 7).collect())) == [(1, 2020, 2, 0), (1, 2021, 20, 0), (2, 2021, 10, 0), (4, 2021, 3, 0)]


def test_strata_tell_a_null_sex_from_all(spark):
    risk = spark.createDataFrame([(1, D(2020, 1, 1), D(2020, 1, 10)), (2, D(2020, 1, 1), D(2020, 1, 10))], "subject_id long, cohort_start_date date, cohort_end_date date")
    person = spark.createDataFrame([(1, None, 1990), (2, 8532, None), (2, 8532, None)], "person_id long, gender_concept_id int, year_of_birth int")
    o = spark.createDataFrame([(1, D(2020, 1, 2))], "person_id long, d date")
    rows = {(r.strata, r.gender_concept_id, r.age_from, r.year): (r.persons_at_risk, r.person_days, r.outcomes, r.person_outcomes) for r in characterise.incidence_strata(risk, o, "d", person).collect()}
    assert rows[7, None, None, None] == (2, 20, 1, 1) and rows[3, None, None, None] == (1, 10, 1, 1) and rows[3, 8532, None, None] == (1, 10, 0, 0)
    assert rows[0, None, 30, 2020] == (1, 10, 1, 1) and rows[5, None, None, None] == (1, 10, 0, 0) and len(rows) == 14


def test_outcomes_beside_exposure(spark):
    eras_ = spark.createDataFrame([(1, D(2020, 1, 10), D(2020, 1, 20)), (1, D(2020, 3, 1), D(2020, 3, 1)), (2, D(2020, 1, 1), D(2020, 1, 1))], "subject_id long, era_start date, era_end date")
    days = [(1, D(2020, 1, 9)), (1, D(2020, 1, 10)), (1, D(2020, 1, 20)), (1, D(2020, 1, 20)), (1, D(2020, 1, 21)), (1, D(2020, 3, 1)), (1, D(2020, 3, 2)), (2, D(2020, 1, 2)), (3, D(2020, 1, 1)), (1, None)]
    o = spark.createDataFrame([(p, d, 7) for p, d in days], "person_id long, d date, kind int")
    got = sorted(map(tuple, characterise.time_to_event(eras_, o, "d", "kind", (30,)).collect()))
    assert got == sorted([(7, 1, "before", 30, -1, 1), (7, 0, "during first", 30, 0, 2), (7, 0, "between", 30, 0, 1), (7, 0, "during later", 30, 1, 1), (7, 0, "after", 30, 1, 1), (7, 1, "after", 30, 0, 1)])
    assert characterise.time_to_event(eras_.limit(0), o, "d", "kind").count() == 0


def test_visits_around_an_episode(spark):
    cohort = spark.createDataFrame([(1, 1, D(2020, 6, 1)), (1, 2, D(2020, 6, 2))], "subject_id long, episode_id int, cohort_start_date date")
    spans = [(D(2020, 6, 1), D(2020, 6, 3)), (D(2020, 5, 1), None), (D(2020, 5, 2), D(2020, 4, 1)), (D(2020, 7, 2), D(2020, 7, 3)), (None, None)]
    visits = spark.createDataFrame([(1, 9201, a, b, 5) for a, b in spans], "person_id long, visit_concept_id int, visit_start_date date, visit_end_date date, episode_id int")
    got = {r.context: (r.n_persons, r.n_episodes) for r in characterise.visit_context(cohort, visits).collect()}
    # 2 May is 30 days before 1 June; 2 July is 30 days after 2 June
    assert got == {"on": (1, 1), "during": (1, 1), "before": (1, 1), "after": (1, 1)}
