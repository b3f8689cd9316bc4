"""Queries of rates, effect estimates, pooling policies, privacy reducers and harmonised sites, and their SQL."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from .catalog import _RISK, _outcomes, _risk
from .cdm.fixture import table, view
from .operators import cohort as C
from .operators import disclosure as G
from .operators import estimates as X
from .operators import explore as E
from .operators import people as H
from .operators import pooling as P
from .operators import privacy as D
from .operators import results as Q
from .operators import survival as S
from .operators import temporal as T
from .operators import verbs as V
from .registry import index, index_sql, query, rounded
from .sources import schemas as K
from .streaming import events as Z

SITES = 3
_RATE = ("persons_at_risk", "person_days", "outcomes", "person_outcomes")


def _by_site(spark, d, name, *also):
    return view(spark, d, name).join(view(spark, d, "person").select("person_id", "site_id", *also), "person_id")


def _risk_of(spark, d, *columns):
    return _risk(spark, d).join(view(spark, d, "person").select(F.col("person_id").alias("subject_id"), *columns), "subject_id")


def _outcome(spark, d):
    return _outcomes(spark, d)["x"]


_INCIDENCE = _RISK + """, f AS (SELECT subject_id, episode_id, count(*) AS n, min(day) AS first FROM e WHERE outcome_name = 'x' GROUP BY ALL),
q AS (SELECT r.subject_id, n, coalesce(first, exit_day) - entry_day AS days, site_id, gender_concept_id FROM risk r JOIN person p ON p.person_id = r.subject_id LEFT JOIN f ON r.subject_id = f.subject_id AND r.episode_id = f.episode_id WHERE exit_day >= 0),
s AS (SELECT {key}, count(DISTINCT subject_id) AS persons_at_risk, CAST(sum(days) AS BIGINT) AS person_days, CAST(coalesce(sum(n), 0) AS BIGINT) AS outcomes, count(DISTINCT CASE WHEN n > 0 THEN subject_id END) AS person_outcomes FROM q GROUP BY {key})
SELECT {out}, persons_at_risk, person_days, outcomes, person_outcomes, round(person_outcomes / CAST(persons_at_risk AS DOUBLE), 6) AS proportion, round(person_outcomes * 1000.0 / person_days, 6) AS rate FROM s"""


@query(_INCIDENCE.replace("{key}", "gender_concept_id").replace("{out}", "gender_concept_id"))
def incidence_rate(spark, d):
    out = X.incidence(_risk_of(spark, d, "gender_concept_id"), *_outcome(spark, d), ["gender_concept_id"])
    return out.withColumn("rate", F.col("rate") * 1000).select("gender_concept_id", *_RATE, *rounded("proportion", "rate"))


@query(_INCIDENCE.replace("{key}", "1").replace("SELECT 1, ", "SELECT 'all' AS stratum, ").replace("GROUP BY 1)", ")").replace("{out}", "stratum"))
def pool_incidence(spark, d):
    each = X.incidence(_risk_of(spark, d, "site_id"), *_outcome(spark, d), ["site_id"]).withColumn("stratum", F.lit("all"))
    roles = {c: ("sum", c) for c in _RATE} | {"proportion": ("ratio", "person_outcomes", "persons_at_risk", 1.0), "rate": ("ratio", "person_outcomes", "person_days", 1000.0)}
    return P.tabular(each, ["stratum"], roles, SITES).select("stratum", *_RATE, *rounded("proportion", "rate"))


_ARMS = _RISK + """, f AS (SELECT subject_id, episode_id, min(day) AS first FROM e WHERE outcome_name = 'x' GROUP BY ALL),
q AS (SELECT site_id, gender_concept_id AS g, r.subject_id, first, coalesce(first, exit_day) - entry_day AS days FROM risk r JOIN person p ON p.person_id = r.subject_id LEFT JOIN f ON r.subject_id = f.subject_id AND r.episode_id = f.episode_id WHERE exit_day >= 0),
arms AS (SELECT site_id, count(DISTINCT CASE WHEN g = 8532 AND first IS NOT NULL THEN subject_id END) AS target_events, CAST(coalesce(sum(CASE WHEN g = 8532 THEN days END), 0) AS BIGINT) AS target_days,
  count(DISTINCT CASE WHEN g = 8507 AND first IS NOT NULL THEN subject_id END) AS comparator_events, CAST(coalesce(sum(CASE WHEN g = 8507 THEN days END), 0) AS BIGINT) AS comparator_days FROM q GROUP BY site_id),
est AS (SELECT *, CASE WHEN target_events > 0 AND comparator_events > 0 THEN ln(CAST(target_events AS DOUBLE) * comparator_days / (CAST(comparator_events AS DOUBLE) * target_days)) END AS log_estimate,
  CASE WHEN target_events > 0 AND comparator_events > 0 THEN sqrt(1.0 / target_events + 1.0 / comparator_events) END AS se FROM arms)"""


def _arms(spark, d):
    risk = _risk_of(spark, d, "site_id", "gender_concept_id")
    return X.comparative(risk.where("gender_concept_id = 8532"), risk.where("gender_concept_id = 8507"), *_outcome(spark, d), ["site_id"])


@query(_ARMS + " SELECT site_id, target_events, target_days, comparator_events, comparator_days, round(log_estimate, 6) AS log_estimate, round(se, 6) AS se FROM est")
def effect_comparative(spark, d):
    return _arms(spark, d).select("site_id", "target_events", "target_days", "comparator_events", "comparator_days", *rounded("log_estimate", "se"))


@query(_ARMS + """, w AS (SELECT log_estimate AS y, se, 1 / (se * se) AS w FROM est WHERE se > 0), o2 AS (SELECT count(*) AS k, sum(w) AS sw, sum(w * w) AS sww, sum(w * y) / sum(w) AS fixed FROM w),
h AS (SELECT o2.*, (SELECT sum(w * (y - fixed) * (y - fixed)) FROM w) AS q FROM o2), t AS (SELECT *, greatest(0, (q - (k - 1)) / (sw - sww / sw)) AS tau2, greatest(0, (q - (k - 1)) / nullif(q, 0)) * 100 AS i2 FROM h)
SELECT k, round(fixed, 6) AS fixed, round(q, 6) AS q, round(coalesce(i2, 0), 6) AS i2, round(tau2, 6) AS tau2, round((SELECT sum(y / (se * se + tau2)) / sum(1 / (se * se + tau2)) FROM w), 6) AS random FROM t""")
def pool_effect_heterogeneity(spark, d):
    return P.effects(_arms(spark, d), []).select("k", *rounded("fixed", "q", "i2", "tau2", "random"))


@query("""WITH x0 AS (SELECT person_id, drug_exposure_start_date AS a, drug_exposure_end_date AS b FROM drug_exposure WHERE drug_concept_id BETWEEN 3001 AND 3010 AND drug_exposure_end_date >= drug_exposure_start_date),
x1 AS (SELECT *, CASE WHEN a > max(b) OVER (PARTITION BY person_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 1 ELSE 0 END AS new FROM x0),
x2 AS (SELECT *, sum(new) OVER (PARTITION BY person_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS run FROM x1), x AS (SELECT person_id, min(a) AS a, max(b) AS b FROM x2 GROUP BY person_id, run),
p AS (SELECT o.person_id, site_id, observation_period_start_date AS s, observation_period_end_date AS e FROM observation_period o JOIN person q ON o.person_id = q.person_id),
exposed AS (SELECT p.person_id, sum(date_diff('day', greatest(a, s), least(b, e)) + 1) AS days FROM p JOIN x ON p.person_id = x.person_id AND a <= e AND b >= s GROUP BY 1),
observed AS (SELECT person_id, max(site_id) AS site_id, sum(date_diff('day', s, e) + 1) AS days FROM p GROUP BY 1),
ev AS (SELECT p.person_id, condition_start_date AS d FROM p JOIN condition_occurrence c ON p.person_id = c.person_id AND condition_concept_id IN (2001, 2002, 2003) AND condition_start_date BETWEEN s AND e),
n AS (SELECT person_id, count(*) AS events, count(CASE WHEN EXISTS (SELECT 1 FROM x WHERE x.person_id = ev.person_id AND d BETWEEN a AND b) THEN 1 END) AS on_events FROM ev GROUP BY 1),
g AS (SELECT site_id, CAST(sum(on_events) AS BIGINT) AS exposed_events, CAST(sum(exposed.days) AS BIGINT) AS exposed_days, CAST(sum(events - on_events) AS BIGINT) AS other_events, CAST(sum(observed.days - exposed.days) AS BIGINT) AS other_days
  FROM n JOIN exposed ON n.person_id = exposed.person_id JOIN observed ON n.person_id = observed.person_id GROUP BY site_id)
SELECT *, round(CASE WHEN exposed_events > 0 AND other_events > 0 THEN ln(CAST(exposed_events AS DOUBLE) * other_days / (CAST(other_events AS DOUBLE) * exposed_days)) END, 6) AS log_estimate,
  round(CASE WHEN exposed_events > 0 AND other_events > 0 THEN sqrt(1.0 / exposed_events + 1.0 / other_events) END, 6) AS se FROM g""")
def effect_self_controlled(spark, d):
    drugs = view(spark, d, "drug_exposure").where("drug_concept_id BETWEEN 3001 AND 3010")
    outcome = view(spark, d, "condition_occurrence").where("condition_concept_id IN (2001, 2002, 2003)")
    out = X.self_controlled(_by_site(spark, d, "observation_period"), drugs, "drug_exposure_start_date", "drug_exposure_end_date", outcome, "condition_start_date", ["site_id"])
    return out.select("site_id", "exposed_events", "exposed_days", "other_events", "other_days", *rounded("log_estimate", "se"))


@query("SELECT gender_concept_id AS value, count(DISTINCT person_id) AS n_persons FROM person GROUP BY 1 HAVING count(DISTINCT person_id) >= 3")
def person_count_by_gender(spark, d):
    return X.persons_by(view(spark, d, "person"), "gender_concept_id", 3)


def _distribution(metric: str, value: str) -> None:
    def f(spark, d):
        rows = Q.of_episodes(index(spark, d), view(spark, d, "person"), metric)
        return Q.distribution(rows, "covariate", "value").select("concept_id", "n", *rounded("mean", "sd", "p10", "median", "p90"))

    f.__name__ = f"distribution_{metric}"
    query(index_sql() + f""", v AS (SELECT {value} AS v FROM idx JOIN person ON subject_id = person_id)
SELECT '{metric}' AS concept_id, count(v) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS sd, round(quantile_cont(v, 0.1), 6) AS p10, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.9), 6) AS p90 FROM v""")(f)


_distribution("age", "year(cohort_start_date) - year_of_birth")
_distribution("time_in_cohort", "date_diff('day', cohort_start_date, cohort_end_date)")


@query("SELECT measurement_concept_id AS concept_id, count(value_as_number) AS n, round(avg(value_as_number), 6) AS mean, round(stddev_samp(value_as_number), 6) AS sd, round(quantile_cont(value_as_number, 0.1), 6) AS p10, round(quantile_cont(value_as_number, 0.5), 6) AS median, round(quantile_cont(value_as_number, 0.9), 6) AS p90 FROM measurement WHERE value_as_number IS NOT NULL AND person_id IN (SELECT subject_id FROM cohort WHERE cohort_definition_id = 1) GROUP BY 1")
def distribution_in_cohort(spark, d):
    out = Q.distribution(view(spark, d, "measurement"), "measurement_concept_id", "value_as_number", view(spark, d, "cohort").where("cohort_definition_id = 1"))
    return out.select("concept_id", "n", *rounded("mean", "sd", "p10", "median", "p90"))


@query("SELECT condition_occurrence_id FROM condition_occurrence WHERE condition_start_date BETWEEN DATE '1998-03-01' AND DATE '1998-06-30'")
def events_calendar(spark, d):
    return T.calendar(view(spark, d, "condition_occurrence"), "condition_start_date", "1998-03-01", "1998-06-30").select("condition_occurrence_id")


@query("""WITH l AS (SELECT *, CASE WHEN date_diff('day', lag(condition_start_date) OVER (PARTITION BY person_id, condition_concept_id ORDER BY condition_start_date, condition_occurrence_id), condition_start_date) <= 120 THEN 0 ELSE 1 END AS f FROM condition_occurrence),
c AS (SELECT *, sum(f) OVER (PARTITION BY person_id, condition_concept_id ORDER BY condition_start_date, condition_occurrence_id ROWS UNBOUNDED PRECEDING) AS ch FROM l),
n AS (SELECT *, row_number() OVER (PARTITION BY person_id, condition_concept_id, ch ORDER BY condition_start_date DESC, condition_occurrence_id DESC) AS rn FROM c) SELECT person_id, condition_concept_id, condition_occurrence_id FROM n WHERE rn = 1""")
def event_min_gap_by_concept_last(spark, d):
    out = T.min_gap(view(spark, d, "condition_occurrence"), ["person_id", "condition_concept_id"], "condition_start_date", "condition_occurrence_id", 120, "last")
    return out.select("person_id", "condition_concept_id", "condition_occurrence_id")


_KEPT = """, u AS (SELECT DISTINCT subject_id, episode_id, outcome_name, day FROM {from}), kept AS (SELECT subject_id, episode_id, outcome_name, min(day) AS day FROM u GROUP BY ALL
  UNION ALL SELECT k.subject_id, k.episode_id, k.outcome_name, (SELECT min(u.day) FROM u WHERE u.subject_id = k.subject_id AND u.episode_id = k.episode_id AND u.outcome_name = k.outcome_name AND u.day > k.day + {days}) FROM kept k WHERE k.day IS NOT NULL)
SELECT subject_id, episode_id, outcome_name, CAST(row_number() OVER (PARTITION BY subject_id, episode_id, outcome_name ORDER BY day) AS INT) AS event_number, day AS event_days_from_index FROM kept WHERE day IS NOT NULL"""


@query(_RISK.replace("WITH ", "WITH RECURSIVE ", 1) + _KEPT.replace("{from}", "e").replace("{days}", "60"))
def survival_recurrent_washout(spark, d):
    return S.recurrent(_risk(spark, d), _outcomes(spark, d), 60)


@query(_RISK + """, u AS (SELECT subject_id, episode_id, day, min(outcome_name) AS outcome_name FROM e GROUP BY ALL)
SELECT subject_id, episode_id, outcome_name, CAST(row_number() OVER (PARTITION BY subject_id, episode_id, outcome_name ORDER BY day) AS INT) AS event_number, day AS event_days_from_index FROM u""")
def survival_recurrent_priority(spark, d):
    return S.recurrent(_risk(spark, d), _outcomes(spark, d), ties="priority")


@query(_RISK + """, x AS (SELECT subject_id, episode_id, min(day) AS dx FROM e WHERE outcome_name = 'x' AND day > 0 GROUP BY ALL),
y AS (SELECT subject_id, episode_id, min(day) AS dy FROM e WHERE outcome_name = 'y' AND day > 0 GROUP BY ALL), z AS (SELECT r.subject_id, r.episode_id, exit_day, dx, dy FROM risk r LEFT JOIN x USING (subject_id, episode_id) LEFT JOIN y USING (subject_id, episode_id) WHERE exit_day >= 0),
a AS (SELECT *, CASE WHEN dx IS NOT NULL AND (dy IS NULL OR dx <= dy) THEN dx END AS tx, CASE WHEN dy IS NOT NULL AND (dx IS NULL OR dy < dx) THEN dy END AS ty FROM z),
later AS (SELECT a.subject_id, a.episode_id, min(e.day) AS day FROM a JOIN e ON a.subject_id = e.subject_id AND a.episode_id = e.episode_id AND e.outcome_name = 'y' AND e.day >= a.tx GROUP BY ALL),
q AS (SELECT subject_id, episode_id, 'start' AS from_state, 'x' AS to_state, 0.0 AS t_start, CAST(coalesce(tx, ty, exit_day) AS DOUBLE) AS t_stop, CASE WHEN tx IS NULL THEN 0 ELSE 1 END AS status FROM a UNION ALL SELECT subject_id, episode_id, 'start', 'y', 0.0, CAST(coalesce(tx, ty, exit_day) AS DOUBLE), CASE WHEN ty IS NULL THEN 0 ELSE 1 END FROM a
UNION ALL SELECT a.subject_id, a.episode_id, 'x', 'y', CAST(tx AS DOUBLE), CASE WHEN day = tx THEN tx + 0.01::DOUBLE ELSE CAST(coalesce(day, exit_day) AS DOUBLE) END, CASE WHEN day IS NULL THEN 0 ELSE 1 END FROM a LEFT JOIN later l ON a.subject_id = l.subject_id AND a.episode_id = l.episode_id WHERE tx IS NOT NULL)
SELECT subject_id, episode_id, from_state, to_state, CAST(t_start AS DOUBLE) AS t_start, t_stop, status FROM q WHERE t_stop > t_start""")
def survival_multi_state_sequential(spark, d):
    risk = _risk(spark, d)
    e = S._at_risk(risk, _outcomes(spark, d)).withColumnRenamed("outcome_name", "state")
    return S.multi_state(risk, e, ["start", "x", "y"], {"start": ["x", "y"], "x": ["y"]}, "sequential")


_PART = "SELECT site_id, condition_concept_id, count(*) AS n FROM condition_occurrence c JOIN person p ON c.person_id = p.person_id WHERE NOT (site_id = 0 AND condition_concept_id % 2 = 1) GROUP BY ALL"


def _part(spark, d):
    """Counts of conditions by site; one site has none of the odd ones."""
    rows = _by_site(spark, d, "condition_occurrence").where("NOT (site_id = 0 AND condition_concept_id % 2 = 1)")
    return rows.groupBy("site_id", "condition_concept_id").agg(F.count("*").alias("n"))


@query(f"WITH s AS ({_PART}) SELECT condition_concept_id, CASE WHEN condition_concept_id % 2 = 0 THEN CAST(sum(n) AS BIGINT) END AS n FROM s GROUP BY 1")
def pool_counts_missing_site(spark, d):
    return P.counts(_part(spark, d), ["condition_concept_id"], ["n"], SITES)


@query(f"WITH s AS ({_PART}) SELECT condition_concept_id, CAST(sum(n) AS BIGINT) AS n FROM s GROUP BY 1")
def pool_counts_relaxed(spark, d):
    return P.counts(_part(spark, d), ["condition_concept_id"], ["n"], SITES, strict=False)


@query(f"WITH s AS ({_PART}) SELECT condition_concept_id, CAST(sum(n) AS BIGINT) AS n FROM s GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def pool_top_k_relaxed(spark, d):
    return P.top(_part(spark, d), "condition_concept_id", "n", SITES, 10, strict=False)


@query(f"WITH s AS ({_PART}) SELECT condition_concept_id, CAST(sum(n) AS BIGINT) AS n, TRUE AS no_p90 FROM s GROUP BY 1 HAVING count(DISTINCT site_id) = 3")
def pool_tabular_missing_site(spark, d):
    out = P.tabular(_part(spark, d), ["condition_concept_id"], {"n": ("sum", "n"), "p90": ("nonpoolable", "double")}, SITES)
    return out.select("condition_concept_id", "n", F.col("p90").isNull().alias("no_p90"))


@query(f"WITH s AS ({_PART}) SELECT condition_concept_id, CAST(sum(n) AS BIGINT) AS n, CAST(max(n) AS BIGINT) AS most FROM s GROUP BY 1")
def pool_tabular_relaxed(spark, d):
    return P.tabular(_part(spark, d), ["condition_concept_id"], {"n": ("sum", "n"), "most": ("max", "n")}, SITES, strict=False)


@query("""SELECT CAST(date_trunc('year', visit_start_date) AS DATE) AS period, count(*) AS n_records FROM visit_occurrence v JOIN person p ON v.person_id = p.person_id WHERE NOT (site_id = 1 AND year(visit_start_date) = 1997) GROUP BY 1""")
def pool_date_counts_relaxed(spark, d):
    rows = _by_site(spark, d, "visit_occurrence").where("NOT (site_id = 1 AND year(visit_start_date) = 1997)")
    each = rows.groupBy("site_id", F.to_date(F.date_trunc("year", "visit_start_date")).alias("period")).agg(F.count("*").alias("n_records"))
    return P.tabular(each, ["period"], {"n_records": ("sum", "n_records")}, SITES, strict=False)


@query("""SELECT CAST(least(3, floor(value_as_number / 100)) AS INT) AS bin, CAST(least(3, floor(value_as_number / 100)) * 100 AS DOUBLE) AS bin_start, CAST(least(3, floor(value_as_number / 100)) * 100 + 100 AS DOUBLE) AS bin_end, count(*) AS n
FROM measurement m JOIN person p ON m.person_id = p.person_id WHERE value_as_number >= 0 AND site_id < 2 GROUP BY 1, 2, 3""")
def pool_histogram_relaxed(spark, d):
    rows = _by_site(spark, d, "measurement").where("value_as_number >= 0").withColumn("bin", F.least(F.lit(3), F.floor(F.col("value_as_number") / 100)).cast("int"))
    each = rows.groupBy("site_id", "bin").agg(F.count("*").alias("n"))
    wide = F.when(F.col("site_id") < 2, 100.0).otherwise(101.0)  # the edges of one site are others
    each = each.withColumn("bin_start", F.col("bin") * wide).withColumn("bin_end", (F.col("bin") + 1) * wide)
    first = each.where("site_id < 2").select("bin").distinct()
    return P.histogram(each.join(first, "bin", "left_semi"), SITES, strict=False)


_DRILLED = "FROM measurement m JOIN person p ON m.person_id = p.person_id WHERE measurement_concept_id = 4003"


@query(f"SELECT count(*) AS n_records, count(DISTINCT m.person_id) AS n_persons {_DRILLED} HAVING count(DISTINCT site_id) = 3")
def pool_drilldown_summary(spark, d):
    return P.counts(_drilled(spark, d, "summary"), [], ["n_records", "n_persons"], SITES)


@query(f"WITH s AS (SELECT site_id, value_as_concept_id AS value, floor(count(*) / 5) * 5 AS n {_DRILLED} GROUP BY 1, 2 HAVING count(DISTINCT m.person_id) >= 3) SELECT value, CAST(sum(n) AS BIGINT) AS n FROM s GROUP BY 1 HAVING count(*) = 3")
def pool_drilldown_categories(spark, d):
    return P.tabular(_drilled(spark, d, "categories"), ["value"], {"n": ("sum", "n")}, SITES)


def _drilled(spark, d, part):
    """A part of the drilldown of each site, as its site would give it."""
    rows, out = _by_site(spark, d, "measurement"), None
    for s in range(SITES):
        one = E.drilldown(rows.where(F.col("site_id") == s), "measurement_concept_id", 4003, "value_as_number", "measurement_date", "value_as_concept_id")[part].withColumn("site_id", F.lit(s))
        out = one if out is None else out.unionByName(one)
    return out


def _drill(part: str, text: str, *columns) -> None:
    def f(spark, d):
        out = E.drilldown(view(spark, d, "measurement"), "measurement_concept_id", 4003, "value_as_number", "measurement_date", "value_as_concept_id")[part]
        return out.select(*[F.round(c, 6).alias(c) if c in columns else c for c in out.columns])

    f.__name__ = f"concept_drilldown_{part}"
    query(f"WITH m AS (SELECT * FROM measurement WHERE measurement_concept_id = 4003) {text}")(f)


_drill("histogram", """, v AS (SELECT value_as_number AS v FROM m WHERE value_as_number IS NOT NULL), e AS (SELECT quantile_cont(v, 0.05) AS lo, (quantile_cont(v, 0.95) - quantile_cont(v, 0.05)) / 20 AS w FROM v),
c AS (SELECT CAST(greatest(0, least(19, floor((v - lo) / w))) AS INT) AS bin, count(*) AS n FROM v, e GROUP BY 1) SELECT CAST(i AS INT) AS bin, round(lo + i * w, 6) AS bin_start, round(lo + (i + 1) * w, 6) AS bin_end, coalesce(n, 0) AS n FROM range(20) t(i) CROSS JOIN e LEFT JOIN c ON i = bin""", "bin_start", "bin_end")
_drill("quantiles", " UNION ALL ".join(f"SELECT CAST({p} AS DOUBLE) AS prob, round(quantile_cont(value_as_number, {p}), 2) AS value FROM m" for p in (0.05, 0.25, 0.5, 0.75, 0.95)))
_drill("categories", "SELECT value_as_concept_id AS value, CAST(floor(count(*) / 5) * 5 AS BIGINT) AS n, CAST(floor(count(DISTINCT person_id) / 5) * 5 AS BIGINT) AS n_persons FROM m GROUP BY 1 HAVING count(DISTINCT person_id) >= 3 ORDER BY 2 DESC, 1 LIMIT 20")
_drill("missingness", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_total, count(*) - count({c}) AS n_missing, round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 6) AS missing_rate FROM m" for c in ("value_as_number", "value_as_concept_id")), "missing_rate")


@query("""WITH p AS (SELECT person_id, count(*) AS n, count(value_as_number) AS s, avg(value_as_number) AS m FROM measurement WHERE measurement_concept_id = 4003 GROUP BY person_id)
SELECT CAST(sum(n) AS BIGINT) AS n, count(*) AS n_persons, round(avg(m), 6) AS mean, round((SELECT quantile_cont(value_as_number, 0.5) FROM measurement WHERE measurement_concept_id = 4003), 2) AS median FROM p""")
def concept_summary_numeric(spark, d):
    out = E.summary(view(spark, d, "measurement").where("measurement_concept_id = 4003"), "value_as_number")
    return out.select("n", "n_persons", *rounded("mean"), F.col("quantiles")[F.lit(0.5)].alias("median"))


@query("""WITH a AS (SELECT DISTINCT person_id FROM condition_occurrence WHERE condition_concept_id = 2001), b AS (SELECT DISTINCT person_id FROM drug_exposure WHERE drug_concept_id = 3002), u AS (SELECT person_id FROM condition_occurrence UNION SELECT person_id FROM drug_exposure)
SELECT has_a, has_b, count(*) AS n_persons FROM (SELECT CAST(person_id IN (SELECT person_id FROM a) AS INT) AS has_a, CAST(person_id IN (SELECT person_id FROM b) AS INT) AS has_b FROM u) x GROUP BY ALL HAVING count(*) >= 3""")
def comorbidity_of_two_tables(spark, d):
    return E.comorbidity(view(spark, d, "condition_occurrence"), "condition_concept_id", 2001, 3002, (view(spark, d, "drug_exposure"), "drug_concept_id"), 3)


_ONE = "WITH o AS ({one}) SELECT CAST(s.level AS INT) AS level, count(o.person_id) AS n FROM (VALUES (2001), (2002), (2003), (2999)) s(level) LEFT JOIN o ON s.level = o.level GROUP BY s.level"
_ROWS = "SELECT person_id, condition_concept_id AS level, condition_start_date AS d, condition_occurrence_id AS k FROM condition_occurrence WHERE condition_concept_id IN (2001, 2002, 2003, 2999)"


def _categorical(how: str, one: str, cap: int = 1) -> None:
    def f(spark, d):
        order = () if how == "mode" else ("condition_start_date", "condition_occurrence_id")
        return D.categorical(view(spark, d, "condition_occurrence"), "condition_concept_id", [2001, 2002, 2003, 2999], cap, how, order)

    f.__name__ = f"privacy_categorical_{how}"
    query(_ONE.replace("{one}", one))(f)


_categorical("mode", f"SELECT person_id, level FROM (SELECT person_id, level, row_number() OVER (PARTITION BY person_id ORDER BY count(*) DESC, level) AS rn FROM ({_ROWS}) r GROUP BY person_id, level) x WHERE rn = 1")
_categorical("first", f"SELECT person_id, level FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY d, k, level) AS rn FROM ({_ROWS}) r) x WHERE rn = 1")
_categorical("last", f"SELECT person_id, level FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY d DESC, k DESC, level) AS rn FROM ({_ROWS}) r) x WHERE rn = 1")
_categorical("records", f"SELECT person_id, level FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY d, k, level) AS rn FROM ({_ROWS}) r) x WHERE rn <= 2", 2)


def _mean(how: str, value: str) -> None:
    def f(spark, d):
        order = ("drug_exposure_start_date", "drug_exposure_id") if how in ("first", "last") else ()
        return D.mean(view(spark, d, "drug_exposure"), "days_supply", 10.0, 40.0, how=how, order=order).select("n", "sum_grid", *rounded("value"))

    f.__name__ = f"privacy_mean_{how}"
    query(f"""WITH o AS (SELECT {value} AS v FROM drug_exposure WHERE days_supply IS NOT NULL GROUP BY person_id), g AS (SELECT count(*) AS n, CAST(sum(floor((greatest(10.0, least(40.0, v)) - 10.0) / 30.0 * 1000 + 0.5)) AS BIGINT) AS sum_grid FROM o)
SELECT n, sum_grid, round(10 + 30.0 * sum_grid / (n * 1000), 6) AS value FROM g""")(f)


for _how, _value in {"min": "min(days_supply)", "max": "max(days_supply)", "median": "median(days_supply)", "first": "arg_min(days_supply, (drug_exposure_start_date, drug_exposure_id, days_supply))", "last": "arg_max(days_supply, (drug_exposure_start_date, drug_exposure_id, -days_supply))"}.items():
    _mean(_how, _value)


@query("""WITH o AS (SELECT median(value_as_number) AS v FROM measurement WHERE value_as_number IS NOT NULL GROUP BY person_id), b AS (SELECT * FROM (VALUES (0, 0.0, 100.0), (1, 100.0, 200.0), (2, 200.0, 400.0)) t(bin, bin_start, bin_end))
SELECT bin, CAST(bin_start AS DOUBLE) AS bin_start, CAST(bin_end AS DOUBLE) AS bin_end, count(v) AS n FROM b LEFT JOIN o ON v >= bin_start AND (v < bin_end OR (bin = 2 AND v = bin_end)) GROUP BY 1, 2, 3""")
def privacy_numeric_median(spark, d):
    return D.numeric(view(spark, d, "measurement"), "value_as_number", [0.0, 100.0, 200.0, 400.0], "median")


@query("""WITH o AS (SELECT min(visit_start_date) AS v FROM visit_occurrence GROUP BY person_id), b AS (SELECT * FROM (VALUES (0, DATE '1995-01-01', DATE '1996-01-01'), (1, DATE '1996-01-01', DATE '1998-01-01'), (2, DATE '1998-01-01', DATE '2001-08-01')) t(bin, bin_start, bin_end))
SELECT bin, bin_start, bin_end, count(v) AS n FROM b LEFT JOIN o ON v >= bin_start AND (v < bin_end OR (bin = 2 AND v = bin_end)) GROUP BY 1, 2, 3""")
def privacy_numeric_dates(spark, d):
    day = datetime.date
    return D.numeric(view(spark, d, "visit_occurrence"), "visit_start_date", [day(1995, 1, 1), day(1996, 1, 1), day(1998, 1, 1), day(2001, 8, 1)], "min")


_RATED = "SELECT count(CASE WHEN v THEN 1 END) AS num, count(*) AS den, round(count(CASE WHEN v THEN 1 END) / CAST(count(*) AS DOUBLE), 6) AS value FROM "


@query(_RATED + "(SELECT arg_min(days_supply > 30, (drug_exposure_start_date, drug_exposure_id)) AS v FROM drug_exposure GROUP BY person_id) x")
def privacy_rate_first(spark, d):
    return D.rate(view(spark, d, "drug_exposure"), F.col("days_supply") > 30, "first", ("drug_exposure_start_date", "drug_exposure_id")).select("num", "den", *rounded("value"))


@query(_RATED + "(SELECT p.person_id, bool_and(days_supply > 10) AS v FROM person p LEFT JOIN drug_exposure x ON p.person_id = x.person_id GROUP BY p.person_id) x")
def privacy_rate_all_persons(spark, d):
    return D.rate(view(spark, d, "drug_exposure"), F.col("days_supply") > 10, "all", persons=view(spark, d, "person")).select("num", "den", *rounded("value"))


def _each_site(spark, d, name, make):
    rows, out = _by_site(spark, d, name), None
    for s in range(SITES):
        one = make(rows.where(F.col("site_id") == s)).withColumn("site_id", F.lit(s))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT CAST(sum(least(n, 5)) AS BIGINT) AS value FROM (SELECT count(*) AS n FROM condition_occurrence c JOIN person p ON c.person_id = p.person_id GROUP BY c.person_id) x")
def pool_privacy_count(spark, d):
    return P.released(_each_site(spark, d, "condition_occurrence", lambda x: D.bounded_count(x, 5)), [], ["value"], SITES)


@query(_ONE.replace("{one}", f"SELECT r.person_id, level FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY d, k, level) AS rn FROM ({_ROWS}) r) r JOIN person p ON r.person_id = p.person_id WHERE rn = 1"))
def pool_privacy_categorical(spark, d):
    order = ("condition_start_date", "condition_occurrence_id")
    each = _each_site(spark, d, "condition_occurrence", lambda x: D.categorical(x, "condition_concept_id", [2001, 2002, 2003, 2999], 1, "first", order))
    return P.released(each, ["level"], ["n"], SITES)


@query(_RATED + "(SELECT bool_or(days_supply > 45) AS v FROM drug_exposure x JOIN person p ON x.person_id = p.person_id GROUP BY x.person_id) x")
def pool_privacy_rate(spark, d):
    return P.released_rate(_each_site(spark, d, "drug_exposure", lambda x: D.rate(x, F.col("days_supply") > 45))).select("num", "den", *rounded("value"))


def _site_tables(spark, d):
    """Persons as three sites would hold them: with other columns and types."""
    p = view(spark, d, "person")
    s = [p.where(F.col("site_id") == i) for i in range(SITES)]
    a = s[0].select("person_id", "gender_concept_id", "year_of_birth", F.lit("x").alias("only_here"), F.col("race_concept_id").alias("race"))
    b = s[1].select("person_id", "gender_concept_id", F.col("year_of_birth").cast("double").alias("year_of_birth"), F.col("race_concept_id").cast("string").alias("race"))
    c = s[2].select("person_id", "gender_concept_id", "year_of_birth", F.col("race_concept_id").alias("race"))
    return {"a": a, "b": b, "c": c}


@query("""WITH u AS (SELECT *, dense_rank() OVER (ORDER BY gender_concept_id) AS g FROM person)
SELECT CASE site_id WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS site, person_id, CAST(g AS INT) AS gender_concept_id, CAST(year_of_birth AS DOUBLE) AS year_of_birth FROM u""")
def harmonised_sites(spark, d):
    return Q.harmonised(_site_tables(spark, d), ["gender_concept_id"])


@query("SELECT * FROM (VALUES ('common', 'gender_concept_id'), ('common', 'person_id'), ('common', 'year_of_birth'), ('mismatch', 'race')) t(kind, column_name)")
def schema_compare(spark, d):
    found = K.compare({s: {"person": t.schema} for s, t in _site_tables(spark, d).items()})
    rows = [("common", c) for c in found["common"]["person"]] + [("mismatch", c) for _, c, _ in found["mismatches"]]
    return spark.createDataFrame(rows, "kind string, column_name string")


@query("SELECT * FROM (VALUES ('concept', 8, 0), ('death', 3, 2), ('person', 8, 3)) t(table_name, n_columns, n_joins)")
def schema_snapshot(spark, d):
    return K.snapshot({t: view(spark, d, t) for t in ("concept", "death", "person")}, spark)


@query("SELECT 'achilles_heel' AS table_name, FALSE AS present, CAST(NULL AS INT) AS n_columns, CAST(NULL AS BIGINT) AS n_rows UNION ALL SELECT 'achilles_results', TRUE, 5, (SELECT count(*) FROM achilles_results)")
def results_status(spark, d):
    return Q.status(["achilles_results", "achilles_heel"], {"achilles_results": view(spark, d, "achilles_results")})


@query("SELECT person_id, year_of_birth, month_of_birth, day_of_birth, site_id FROM person")
def columns_without_sensitive(spark, d):
    return H.without_sensitive(view(spark, d, "person"), ["*_concept_id"])


@query("SELECT person_id, CAST(death_date AS VARCHAR) AS death_date, NULL AS visit_start_date FROM death UNION ALL SELECT person_id, NULL, CAST(visit_start_date AS VARCHAR) FROM visit_occurrence")
def verbs_bind(spark, d):
    out = V.bind([view(spark, d, "death").select("person_id", "death_date"), view(spark, d, "visit_occurrence").select("person_id", "visit_start_date")])
    return out.select("person_id", *[F.col(c).cast("string").alias(c) for c in ("death_date", "visit_start_date")])


@query("SELECT condition_occurrence_id FROM condition_occurrence WHERE condition_concept_id IN (SELECT descendant_concept_id FROM concept_ancestor WHERE ancestor_concept_id IN (1901, 1902))")
def events_of_concept_table(spark, d):
    wanted = C.concept_set(spark.createDataFrame([(1901,), (1902,)], "id int"), view(spark, d, "concept_ancestor"))
    return H.value_in(view(spark, d, "condition_occurrence"), "condition_concept_id", concept="condition_concept_id", concepts=wanted).select("condition_occurrence_id")


def _said(*names):
    return [F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n) for n in names]


@query("SELECT strftime(date_trunc('day', CAST(ts AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_window_counts(spark, d):
    return Z.window_counts(table(spark, d, "events"), "ts", "event_type").select(*_said("window_start"), "event_type", "n")


@query("""WITH l AS (SELECT user_id, CAST(ts AS TIMESTAMP) AS t, CASE WHEN CAST(ts AS TIMESTAMP) < lag(CAST(ts AS TIMESTAMP)) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 12 HOURS THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS run FROM l) SELECT strftime(min(t), '%Y-%m-%d %H:%M:%S') AS session_start, strftime(max(t) + INTERVAL 12 HOURS, '%Y-%m-%d %H:%M:%S') AS session_end, user_id, count(*) AS n FROM s GROUP BY user_id, run""")
def stream_sessions(spark, d):
    return Z.sessions(table(spark, d, "events"), "ts", "user_id", "12 hours").select(*_said("session_start", "session_end"), "user_id", "n")


@query("SELECT site, setting, CAST(v AS DOUBLE) AS value FROM (VALUES ('a', 'band', 5), ('a', 'least_in_cell', 3), ('a', 'least_persons', 3), ('b', 'band', 5), ('b', 'least_in_cell', 10), ('b', 'least_persons', 3)) t(site, setting, v)")
def disclosure_settings(spark, d):
    found = G.described({"a": G.Settings(), "b": G.Settings(least_in_cell=10)}, spark)
    return found.where(F.col("setting").isin("band", "least_in_cell", "least_persons"))


@query("SELECT condition_concept_id AS concept_id, count(DISTINCT person_id) AS n_persons, CAST(floor(count(*) / 5) * 5 AS BIGINT) AS n_records FROM condition_occurrence GROUP BY 1 HAVING count(DISTINCT person_id) >= 20")
def disclosure_cells(spark, d):
    rows, limits = view(spark, d, "condition_occurrence"), G.Settings(least_in_cell=20)
    g = rows.groupBy(F.col("condition_concept_id").alias("concept_id")).agg(F.count_distinct("person_id").alias("n_persons"), F.count("*").alias("n_records"))
    return G.checked(G.gated(rows, G.without_small_cells(g, "n_persons", limits, ["n_records"]), limits), limits)
