"""Queries of eras, pathways, attrition, overlap, differences, performance, closure, noise and policies, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .cdm.fixture import view
from .operators import cohort as C
from .operators import diagnostics as G
from .operators import eras as E
from .operators import pathways as Y
from .operators import people as H
from .operators import performance as M
from .operators import policy as N
from .operators import pooling as P
from .operators import privacy as D
from .operators import vocabulary as V
from .registry import index, index_sql, query, rounded

SITES = 3


def _islands(table: str, key: str, start: str, end: str, gap: int, where: str = "TRUE") -> str:
    """CTEs that end in ``era``: spans of a person's rows of a key without more than gap free days."""
    return f"""x0 AS (SELECT person_id, {key} AS k, {start} AS a, greatest({start}, coalesce({end}, {start})) AS b FROM {table} WHERE {where}),
x1 AS (SELECT *, max(b) OVER (PARTITION BY person_id, k ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM x0),
x2 AS (SELECT *, sum(CASE WHEN prev IS NULL OR a - prev - 1 > {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY person_id, k ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS n FROM x1),
era AS (SELECT person_id, k, CAST(n AS INT) AS era_number, min(a) AS era_start, max(b) AS era_end, count(*) AS n_rows, CAST(coalesce(sum(CASE WHEN a - prev - 1 BETWEEN 1 AND {gap} THEN a - prev - 1 END), 0) AS BIGINT) AS gap_days FROM x2 GROUP BY person_id, k, n)"""


@query("""WITH RECURSIVE r AS (SELECT person_id, drug_concept_id, date_diff('day', DATE '1970-01-01', drug_exposure_start_date) AS a, greatest(1, days_supply) AS n, row_number() OVER (PARTITION BY person_id, drug_concept_id ORDER BY drug_exposure_start_date, days_supply) AS k FROM drug_exposure),
w AS (SELECT person_id, drug_concept_id, k, a, a + n AS b, 1 AS era, 0 AS free FROM r WHERE k = 1
  UNION ALL SELECT r.person_id, r.drug_concept_id, r.k, r.a, greatest(r.a, w.b) + r.n, era + CASE WHEN r.a - w.b > 30 THEN 1 ELSE 0 END, CASE WHEN r.a - w.b BETWEEN 1 AND 30 THEN r.a - w.b ELSE 0 END FROM w JOIN r ON r.person_id = w.person_id AND r.drug_concept_id = w.drug_concept_id AND r.k = w.k + 1)
SELECT person_id, drug_concept_id, era AS era_number, CAST(DATE '1970-01-01' + CAST(min(a) AS INT) AS DATE) AS era_start, CAST(DATE '1970-01-01' + CAST(max(b) - 1 AS INT) AS DATE) AS era_end, count(*) AS n_rows, CAST(sum(free) AS BIGINT) AS gap_days FROM w GROUP BY person_id, drug_concept_id, era""")
def era_drug(spark, d):
    return E.collapse(view(spark, d, "drug_exposure"), ["person_id", "drug_concept_id"], "drug_exposure_start_date", gap=30, supply="days_supply", carry=True)


@query(f"WITH {_islands('condition_occurrence', 'condition_concept_id', 'condition_start_date', 'condition_end_date', 30)} SELECT person_id, k AS condition_concept_id, era_number, era_start, era_end, n_rows, gap_days FROM era")
def era_condition(spark, d):
    return E.collapse(view(spark, d, "condition_occurrence"), ["person_id", "condition_concept_id"], "condition_start_date", "condition_end_date", 30)


_SICK = "condition_concept_id BETWEEN 2001 AND 2008"


@query(f"""WITH {_islands('condition_occurrence', '1', 'condition_start_date', 'condition_end_date', 0, _SICK)},
p AS (SELECT e.person_id, era_start, era_number, min(observation_period_start_date) AS obs_start, max(observation_period_end_date) AS obs_end FROM era e JOIN observation_period o ON e.person_id = o.person_id AND era_start BETWEEN observation_period_start_date AND observation_period_end_date GROUP BY 1, 2, 3 HAVING count(*) = 1)
SELECT person_id AS subject_id, CAST(row_number() OVER (PARTITION BY person_id ORDER BY era_start, era_number) AS INT) AS episode_id, era_start AS cohort_start_date, obs_end AS cohort_end_date, obs_start, obs_end FROM p""")
def cohort_index_all_eras(spark, d):
    eras = E.collapse(view(spark, d, "condition_occurrence").where(_SICK), ["person_id"], "condition_start_date", "condition_end_date")
    return C.index_events(eras, view(spark, d, "observation_period"), "era_start", "era_number", "all")


_PATH_DAYS, _PATH_OVERLAP, _PATH_GAP = 540, 15, 30


def _path_eras(spark, d):
    rows = view(spark, d, "drug_exposure").withColumn("treatment", F.concat(F.lit("class "), F.col("drug_concept_id") % 4))
    return E.collapse(rows, ["person_id", "treatment"], "drug_exposure_start_date", "drug_exposure_end_date", 10).withColumnRenamed("person_id", "subject_id")


def _path_steps(spark, d):
    return Y.steps(index(spark, d), _path_eras(spark, d), "treatment", _PATH_DAYS, _PATH_OVERLAP, _PATH_GAP, least=3)


_STEPS = index_sql() + ", " + _islands("drug_exposure", "concat('class ', CAST(drug_concept_id % 4 AS VARCHAR))", "drug_exposure_start_date", "drug_exposure_end_date", 10) + f""",
j0 AS (SELECT subject_id, episode_id, k AS name, CAST(date_diff('day', cohort_start_date, era_start) AS INT) AS a, CAST(least({_PATH_DAYS}, date_diff('day', cohort_start_date, era_end)) AS INT) AS b FROM idx JOIN era ON subject_id = person_id),
j AS (SELECT * FROM j0 WHERE a BETWEEN 0 AND {_PATH_DAYS} AND b - a + 1 >= 3),
cut AS (SELECT subject_id, episode_id, a AS c FROM j UNION SELECT subject_id, episode_id, b + 1 FROM j),
piece AS (SELECT subject_id, episode_id, c AS s, lead(c) OVER (PARTITION BY subject_id, episode_id ORDER BY c) - 1 AS e FROM cut),
act AS (SELECT p.subject_id, p.episode_id, s, e, name, a, b, row_number() OVER (PARTITION BY p.subject_id, p.episode_id, s ORDER BY a DESC, name) AS rn FROM piece p JOIN j ON p.subject_id = j.subject_id AND p.episode_id = j.episode_id AND a <= s AND b >= e WHERE e IS NOT NULL),
named AS (SELECT x.subject_id, x.episode_id, x.s, x.e, string_agg(x.name, '+' ORDER BY x.name) AS treatment FROM act x JOIN act z ON x.subject_id = z.subject_id AND x.episode_id = z.episode_id AND x.s = z.s AND z.rn = 1 WHERE x.rn = 1 OR least(x.b, z.b) - z.a + 1 >= {_PATH_OVERLAP} GROUP BY 1, 2, 3, 4),
marked AS (SELECT *, CASE WHEN treatment = lag(treatment) OVER q AND s - lag(e) OVER q - 1 <= {_PATH_GAP} THEN 0 ELSE 1 END AS new FROM named WINDOW q AS (PARTITION BY subject_id, episode_id ORDER BY s)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY subject_id, episode_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS step FROM marked),
step AS (SELECT subject_id, episode_id, CAST(step AS INT) AS step, min(treatment) AS treatment, min(s) AS start_day, max(e) AS end_day FROM numbered GROUP BY 1, 2, 3)"""


@query(_STEPS + " SELECT * FROM step")
def pathway_steps(spark, d):
    return _path_steps(spark, d)


@query(_STEPS + """, path AS (SELECT *, array_to_string(list(treatment) OVER (PARTITION BY subject_id, episode_id ORDER BY step ROWS UNBOUNDED PRECEDING), '>') AS path, step = max(step) OVER (PARTITION BY subject_id, episode_id) AS last FROM step WHERE step <= 4)
SELECT path, step, count(DISTINCT subject_id) AS n_persons, count(DISTINCT CASE WHEN last THEN subject_id END) AS n_end FROM path GROUP BY path, step HAVING count(DISTINCT subject_id) >= 2""")
def pathway_counts(spark, d):
    return Y.counts(_path_steps(spark, d), 4, 2)


@query(_STEPS + " SELECT treatment, count(*) AS n_steps, count(DISTINCT subject_id) AS n_persons, round(avg(end_day - start_day + 1), 6) AS mean_days, min(end_day - start_day + 1) AS least_days, max(end_day - start_day + 1) AS most_days FROM step GROUP BY treatment")
def pathway_durations(spark, d):
    return Y.durations(_path_steps(spark, d)).select("treatment", "n_steps", "n_persons", *rounded("mean_days"), "least_days", "most_days")


def _criteria():
    sick, drug = F.col("condition_concept_id").between(2001, 2012), F.col("drug_concept_id")
    return [
        G.Criterion("born before 1975", None, F.col("year_of_birth") < 1975),
        G.Criterion("condition before", "condition", sick, -365, 0),
        G.Criterion("two drugs before", "drug", drug > 0, -365, 0, 2),
        G.Criterion("female", None, F.col("gender_concept_id") == 8532),
        G.Criterion("no drug 3003 after", "drug", drug == 3003, 1, 180, 0, 0),
        G.Criterion("one to three conditions 2020 to 2030", "condition", F.col("condition_concept_id").between(2020, 2030), None, None, 1, 3),
    ]


def _masked(spark, d):
    who = view(spark, d, "person").select(F.col("person_id").alias("subject_id"), "year_of_birth", "gender_concept_id")
    cohort = index(spark, d, "all").join(who, "subject_id")
    sources = {"condition": (view(spark, d, "condition_occurrence"), "condition_start_date"), "drug": (view(spark, d, "drug_exposure"), "drug_exposure_start_date")}
    return cohort, G.masks(cohort, sources, _criteria())


def _n(table: str, date: str, test: str, low: str = "", high: str = "") -> str:
    day = f"date_diff('day', i.cohort_start_date, t.{date})"
    near = (f" AND {day} >= {low}" if low else "") + (f" AND {day} <= {high}" if high else "")
    return f"(SELECT count(*) FROM {table} t WHERE t.person_id = i.subject_id AND {test}{near})"


_FLAGS = index_sql("all") + f""", f AS (SELECT subject_id, episode_id, cohort_start_date, year_of_birth < 1975 AS c1, {_n('condition_occurrence', 'condition_start_date', 'condition_concept_id BETWEEN 2001 AND 2012', '-365', '0')} >= 1 AS c2,
{_n('drug_exposure', 'drug_exposure_start_date', 'drug_concept_id > 0', '-365', '0')} >= 2 AS c3, gender_concept_id = 8532 AS c4, {_n('drug_exposure', 'drug_exposure_start_date', 'drug_concept_id = 3003', '1', '180')} = 0 AS c5,
{_n('condition_occurrence', 'condition_start_date', 'condition_concept_id BETWEEN 2020 AND 2030')} BETWEEN 1 AND 3 AS c6 FROM idx i JOIN person p ON p.person_id = i.subject_id)"""
_NAMES = ("born before 1975", "condition before", "two drugs before", "female", "no drug 3003 after", "one to three conditions 2020 to 2030")


def _attrition_row(i: int) -> str:
    every, rest = [f"c{k}" for k in range(1, 7)], [f"c{k}" for k in range(1, 7) if k != i]
    n = lambda test: f"count(CASE WHEN {test} THEN 1 END)"
    return f"""SELECT {i} AS criterion, '{_NAMES[i - 1]}' AS name, {n(" AND ".join(["TRUE", *every[: i - 1]]))} AS n_in, {n(" AND ".join(every[:i]))} AS n_passed, {n(f"c{i}")} AS n_passed_this,
{n(f"c{i} AND NOT (" + " OR ".join(rest) + ")")} AS n_passed_only, {n(f"NOT c{i} AND " + " AND ".join(rest))} AS n_failed_only FROM f"""


@query(_FLAGS + " UNION ALL ".join([" " + _attrition_row(i) for i in range(1, 7)]))
def attrition(spark, d):
    return G.attrition(_masked(spark, d)[1], _criteria())


@query(_FLAGS + " SELECT subject_id, episode_id, cohort_start_date FROM f WHERE c1 AND c2 AND c3 AND c4 AND c5 AND c6")
def attrition_passing(spark, d):
    cohort, found = _masked(spark, d)
    return G.passing(cohort, found, _criteria()).select("subject_id", "episode_id", "cohort_start_date")


_FIRST = "WITH f AS (SELECT cohort_definition_id AS c, subject_id, min(cohort_start_date) AS s FROM cohort GROUP BY 1, 2), b AS (SELECT x.c AS cohort_1, y.c AS cohort_2, CAST(date_diff('day', x.s, y.s) AS INT) AS days FROM f x JOIN f y ON x.subject_id = y.subject_id AND x.c < y.c)"


@query(_FIRST + " SELECT cohort_1, cohort_2, days, count(*) AS n_persons FROM b GROUP BY ALL")
def cohort_timing(spark, d):
    return G.timing(view(spark, d, "cohort"))


@query(_FIRST + """, s AS (SELECT c, count(*) AS n FROM f GROUP BY c), g AS (SELECT cohort_1, cohort_2, count(*) AS n_both, count(CASE WHEN days > 0 THEN 1 END) AS n_first_1, count(CASE WHEN days = 0 THEN 1 END) AS n_same_day, count(CASE WHEN days < 0 THEN 1 END) AS n_first_2 FROM b GROUP BY ALL)
SELECT g.*, u.n AS n_1, v.n AS n_2, u.n - n_both AS n_only_1, v.n - n_both AS n_only_2 FROM g JOIN s u ON u.c = cohort_1 JOIN s v ON v.c = cohort_2""")
def cohort_overlap(spark, d):
    return G.overlap(view(spark, d, "cohort"))


def _covariates(spark, d):
    """Numbers of conditions by concept, and the groups of persons born before and after 1965."""
    rows = view(spark, d, "condition_occurrence").groupBy(F.col("person_id").alias("subject_id"), F.col("condition_concept_id").alias("covariate_id")).agg(F.count("*").alias("value"))
    who = view(spark, d, "person").select(F.col("person_id").alias("subject_id"), F.when(F.col("year_of_birth") < 1965, 1).otherwise(2).alias("cohort"), "site_id")
    return rows, who


_SMD = """WITH who AS (SELECT person_id, CASE WHEN year_of_birth < 1965 THEN 1 ELSE 2 END AS g FROM person), c AS (SELECT DISTINCT condition_concept_id AS covariate_id FROM condition_occurrence),
v AS (SELECT g, covariate_id, who.person_id, (SELECT count(*) FROM condition_occurrence o WHERE o.person_id = who.person_id AND o.condition_concept_id = c.covariate_id) AS x FROM who CROSS JOIN c),
s AS (SELECT covariate_id, avg(CASE WHEN g = 1 THEN x END) AS mean_1, stddev_samp(CASE WHEN g = 1 THEN x END) AS sd_1, avg(CASE WHEN g = 2 THEN x END) AS mean_2, stddev_samp(CASE WHEN g = 2 THEN x END) AS sd_2 FROM v GROUP BY 1)
SELECT covariate_id, round(mean_1, 6) AS mean_1, round(sd_1, 6) AS sd_1, round(mean_2, 6) AS mean_2, round(sd_2, 6) AS sd_2, round((mean_1 - mean_2) / nullif(sqrt((sd_1 * sd_1 + sd_2 * sd_2) / 2), 0), 6) AS smd FROM s"""


@query(_SMD)
def standardised_differences(spark, d):
    rows, who = _covariates(spark, d)
    sizes = who.groupBy("cohort").agg(F.count_distinct("subject_id").alias("n"))
    return G.standardised(G.covariate_sums(rows, who.drop("site_id")), sizes).select("covariate_id", *rounded("mean_1", "sd_1", "mean_2", "sd_2", "smd"))


@query(_SMD)
def pool_standardised_differences(spark, d):
    rows, who = _covariates(spark, d)
    sizes = who.groupBy("site_id", "cohort").agg(F.count_distinct("subject_id").alias("n"))
    return G.standardised(G.covariate_sums(rows, who, ["site_id"]), sizes).select("covariate_id", *rounded("mean_1", "sd_1", "mean_2", "sd_2", "smd"))


_ERAS_3 = _islands("drug_exposure", "drug_concept_id % 3", "drug_exposure_start_date", "drug_exposure_end_date", 10)
_TRIALS = f"""WITH {_ERAS_3}, e AS (SELECT *, lead(era_start) OVER q AS again, lead(era_end) OVER q AS again_end FROM era WINDOW q AS (PARTITION BY person_id, k ORDER BY era_start)),
o AS (SELECT DISTINCT person_id, condition_concept_id % 2 AS outcome_id, condition_start_date AS d FROM condition_occurrence),
t AS (SELECT e.person_id, k, outcome_id, era_start, era_end, again, again_end, min(d) AS first FROM e JOIN o ON e.person_id = o.person_id AND d BETWEEN era_start AND era_end GROUP BY ALL HAVING era_end - min(d) <= 45),
u AS (SELECT *, CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.person_id = t.person_id AND o.outcome_id = t.outcome_id AND d > era_end AND d <= era_end + 30) THEN 0 ELSE 1 END AS dechallenge,
  CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.person_id = t.person_id AND o.outcome_id = t.outcome_id AND d BETWEEN again AND again_end) THEN 1 ELSE 0 END AS back FROM t),
trial AS (SELECT person_id AS subject_id, k AS exposure_id, outcome_id, CAST(row_number() OVER (PARTITION BY person_id, k, outcome_id ORDER BY era_start) AS INT) AS trial, era_end AS stopped, dechallenge, CASE WHEN dechallenge = 1 THEN again END AS again, CASE WHEN dechallenge = 1 AND again IS NOT NULL THEN back END AS rechallenge FROM u)"""


def _trials(spark, d):
    eras = E.collapse(view(spark, d, "drug_exposure").withColumn("exposure_id", F.col("drug_concept_id") % 3), ["person_id", "exposure_id"], "drug_exposure_start_date", "drug_exposure_end_date", 10)
    outcomes = view(spark, d, "condition_occurrence").select(F.col("person_id").alias("subject_id"), (F.col("condition_concept_id") % 2).alias("outcome_id"), F.col("condition_start_date").alias("outcome_date"))
    return E.challenges(eras.withColumnRenamed("person_id", "subject_id"), outcomes, 45, 30)


@query(_TRIALS + " SELECT * FROM trial")
def challenge_trials(spark, d):
    return _trials(spark, d)


@query(_TRIALS + " SELECT exposure_id, outcome_id, count(*) AS n_trials, count(DISTINCT subject_id) AS n_persons, count(CASE WHEN dechallenge = 1 THEN 1 END) AS n_dechallenge, count(CASE WHEN dechallenge = 0 THEN 1 END) AS n_dechallenge_failed, count(rechallenge) AS n_rechallenge, count(CASE WHEN rechallenge = 1 THEN 1 END) AS n_came_back FROM trial GROUP BY ALL")
def challenge_counts(spark, d):
    return E.challenge_counts(_trials(spark, d))


_SCORED = """WITH n AS (SELECT person_id, count(*) AS n FROM drug_exposure GROUP BY 1), y AS (SELECT DISTINCT person_id FROM condition_occurrence WHERE condition_concept_id BETWEEN 2001 AND 2009),
r AS (SELECT site_id, ((coalesce(n, 0) * 37 + year_of_birth * 11 + CASE WHEN y.person_id IS NULL THEN 0 ELSE 20 END) % 97) / 96.0 AS score, CASE WHEN y.person_id IS NULL THEN 0 ELSE 1 END AS y FROM person p LEFT JOIN n ON p.person_id = n.person_id LEFT JOIN y ON p.person_id = y.person_id)"""


def _scores(spark, d):
    n = view(spark, d, "drug_exposure").groupBy("person_id").agg(F.count("*").alias("n"))
    y = view(spark, d, "condition_occurrence").where("condition_concept_id BETWEEN 2001 AND 2009").select("person_id", F.lit(1).alias("y")).distinct()
    rows = view(spark, d, "person").join(n, "person_id", "left").join(y, "person_id", "left").withColumn("y", F.coalesce("y", F.lit(0)))
    return rows.select("site_id", (((F.coalesce("n", F.lit(0)) * 37 + F.col("year_of_birth") * 11 + F.col("y") * 20) % 97) / 96.0).alias("score"), "y")


_CURVE = _SCORED + """, g AS (SELECT site_id, score, count(CASE WHEN y = 1 THEN 1 END) AS pos, count(CASE WHEN y = 0 THEN 1 END) AS neg FROM r GROUP BY 1, 2),
c AS (SELECT site_id, score AS threshold, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp, CAST(sum(pos) OVER (PARTITION BY site_id) - sum(pos) OVER w AS BIGINT) AS fn, CAST(sum(neg) OVER (PARTITION BY site_id) - sum(neg) OVER w AS BIGINT) AS tn, pos, neg FROM g WINDOW w AS (PARTITION BY site_id ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@query(_CURVE + " SELECT site_id, round(threshold, 6) AS threshold, tp, fp, fn, tn, pos, neg FROM c")
def performance_curve(spark, d):
    return M.curve(_scores(spark, d), "score", "y", ["site_id"], 20).select("site_id", *rounded("threshold"), "tp", "fp", "fn", "tn", "pos", "neg")


@query(_SCORED + ", q AS (SELECT a.site_id, sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END) AS u, count(*) AS n FROM r a JOIN r b ON a.site_id = b.site_id AND a.y = 1 AND b.y = 0 GROUP BY 1) SELECT site_id, (SELECT count(*) FROM r WHERE r.site_id = q.site_id AND y = 1) AS n_pos, (SELECT count(*) FROM r WHERE r.site_id = q.site_id AND y = 0) AS n_neg, round(u / n, 6) AS auc FROM q")
def performance_auc(spark, d):
    return M.auc(_scores(spark, d), "score", "y", ["site_id"]).select("site_id", "n_pos", "n_neg", *rounded("auc"))


@query(_CURVE + """, b AS (SELECT *, CAST(floor((fn + tn) * 10 / (tp + fp + fn + tn)) AS INT) AS bin FROM c)
SELECT site_id, bin, CAST(sum(pos + neg) AS BIGINT) AS n, round(sum(pos) / CAST(sum(pos + neg) AS DOUBLE), 6) AS observed, round(sum(threshold * (pos + neg)) / sum(pos + neg), 6) AS mean_score, round(min(threshold), 6) AS least_score, round(max(threshold), 6) AS most_score FROM b GROUP BY 1, 2""")
def performance_calibration(spark, d):
    return M.calibration(_scores(spark, d), "score", "y", ["site_id"]).select("site_id", "bin", "n", *rounded("observed", "mean_score", "least_score", "most_score"))


_CUTS = [0.1, 0.25, 0.5, 0.75, 0.9, 1.5]
_AT = _SCORED + f""", t(threshold) AS (VALUES {", ".join(f"(CAST({c} AS DOUBLE))" for c in _CUTS)}),
m AS (SELECT site_id, threshold, count(CASE WHEN score >= threshold AND y = 1 THEN 1 END) AS tp, count(CASE WHEN score >= threshold AND y = 0 THEN 1 END) AS fp, count(CASE WHEN score < threshold AND y = 1 THEN 1 END) AS fn, count(CASE WHEN score < threshold AND y = 0 THEN 1 END) AS tn FROM r, t GROUP BY 1, 2)"""


@query(_AT + " SELECT *, round(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 6) AS sensitivity, round(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 6) AS specificity, round(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 6) AS ppv, round(tn / nullif(CAST(tn + fn AS DOUBLE), 0), 6) AS npv FROM m")
def performance_thresholds(spark, d):
    found = M.measures(M.at_thresholds(_scores(spark, d), "score", "y", _CUTS, ["site_id"]))
    return found.select("site_id", "threshold", "tp", "fp", "fn", "tn", *rounded("sensitivity", "specificity", "ppv", "npv"))


@query(_AT + ", s AS (SELECT threshold, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM m GROUP BY 1) SELECT threshold, tp, fp, round(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 6) AS ppv, round(100 * tp / nullif(CAST(tp + fn AS DOUBLE), 0), 6) AS sensitivity FROM s")
def pool_ratio_vector(spark, d):
    each = M.at_thresholds(_scores(spark, d), "score", "y", _CUTS, ["site_id"])
    roles = {"tp": ("sum", "tp"), "fp": ("sum", "fp"), "ppv": ("ratio", "tp", ["tp", "fp"]), "sensitivity": ("ratio", ["tp"], ["tp", "fn"], 100.0)}
    return P.tabular(each, ["threshold"], roles, SITES).select("threshold", "tp", "fp", *rounded("ppv", "sensitivity"))


@query("""WITH g AS (SELECT site_id, drug_concept_id % 5 AS stratum, ln(avg(days_supply)) AS y, stddev_samp(days_supply) / sqrt(count(*)) / avg(days_supply) AS se FROM drug_exposure d JOIN person p ON d.person_id = p.person_id GROUP BY ALL),
w AS (SELECT stratum, count(*) AS k, sum(y / (se * se)) / sum(1 / (se * se)) AS fixed FROM g WHERE se > 0 GROUP BY stratum)
SELECT stratum, CASE WHEN stratum <> 2 THEN k END AS k, CASE WHEN stratum <> 2 THEN round(fixed, 6) END AS fixed FROM w""")
def pool_effects_repeated_site(spark, d):
    """A site repeats its estimate of stratum 1, and gives two of stratum 2."""
    rows = view(spark, d, "drug_exposure").join(view(spark, d, "person").select("person_id", "site_id"), "person_id")
    g = rows.groupBy("site_id", (F.col("drug_concept_id") % 5).alias("stratum"))
    g = g.agg(F.log(F.avg("days_supply")).alias("log_estimate"), (F.stddev_samp("days_supply") / F.sqrt(F.count("*")) / F.avg("days_supply")).alias("se"))
    # the estimate is computed once, then given twice
    given = F.when((F.col("site_id") == 0) & (F.col("stratum") == 1), F.array(F.lit(0.0), F.lit(0.0))).when((F.col("site_id") == 0) & (F.col("stratum") == 2), F.array(F.lit(0.0), F.lit(1.0))).otherwise(F.array(F.lit(0.0)))
    g = g.select("*", F.explode(given).alias("more")).withColumn("log_estimate", F.col("log_estimate") + F.col("more"))
    return P.effects(g, ["stratum"]).select("stratum", "k", *rounded("fixed"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT concept_id_2 AS a, concept_id_1 AS d FROM concept_hierarchy WHERE relationship_id = 'Is a' AND concept_id_1 <> concept_id_2),
w AS (SELECT a, d, 1 AS n FROM e UNION SELECT w.a, e.d, w.n + 1 FROM w JOIN e ON e.a = w.d WHERE w.n < 16)
SELECT a AS ancestor_concept_id, d AS descendant_concept_id, min(n) AS min_levels_of_separation FROM w WHERE a <> d GROUP BY a, d UNION ALL SELECT c, c, 0 FROM (SELECT a AS c FROM e UNION SELECT d FROM e) x""")
def concept_closure(spark, d):
    return V.closure(view(spark, d, "concept_hierarchy"))


@query("""WITH h AS (SELECT person_id, category, max(weight) AS w FROM condition_occurrence JOIN codeset ON condition_concept_id = concept_id GROUP BY 1, 2), s(severe, mild) AS (VALUES (1, 0), (3, 2), (3, 4), (5, 3)),
k AS (SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM s JOIN h o ON o.category = severe WHERE o.person_id = h.person_id AND mild = h.category)), t AS (SELECT person_id, sum(w) AS score FROM k GROUP BY 1)
SELECT p.person_id, CAST(coalesce(score, 0) AS BIGINT) AS score FROM person p LEFT JOIN t ON p.person_id = t.person_id""")
def score_hierarchy(spark, d):
    """A severe category takes the place of its mild one; weights are tiers of a category."""
    return H.score(view(spark, d, "person"), view(spark, d, "condition_occurrence"), "condition_concept_id", view(spark, d, "codeset"), supersedes=[(1, 0), (3, 2), (3, 4), (5, 3)])


_SECRET = b"a site's secret"


def _pads() -> str:
    key = _SECRET.ljust(64, b"\0")
    return ", ".join(f"unhex('{bytes(b ^ x for b in key).hex()}') AS {n}" for n, x in (("ipad", 0x36), ("opad", 0x5C)))


def _noise(message: str, scale: float) -> str:
    """SQL of the noise of a message: the keyed digest, and two draws from it."""
    digest = f"(SELECT sha256(opad || unhex(sha256(ipad || encode({message})))) FROM pads)"
    draw = lambda i: f"CAST(floor(-{scale} * ln((CAST('0x' || substr(h, {i}, 13) AS BIGINT) + 1) / {float(16**13 + 1)}::DOUBLE)) AS BIGINT)"
    return f"(SELECT {draw(1)} - {draw(14)} FROM (SELECT {digest} AS h) x)"


def _part(x: str) -> str:
    return f"length({x}) || ':' || {x}"


def _said(identity: str, statistic: str, *cell: str) -> str:
    return " || ".join([f"'{len(identity)}:{identity}{len(statistic)}:{statistic}'", *map(_part, cell)])


@query(f"""WITH pads AS (SELECT {_pads()}), n AS (SELECT CAST(sum(least(n, 5)) AS BIGINT) AS v FROM (SELECT count(*) AS n FROM condition_occurrence GROUP BY person_id) x) SELECT v + {_noise(_said("conditions by person", "value"), 10.0)} AS value FROM n""")
def release_count(spark, d):
    return D.release(D.bounded_count(view(spark, d, "condition_occurrence"), 5), [], {"value": 5}, _SECRET, "conditions by person", 0.5)


@query(f"""WITH pads AS (SELECT {_pads()}), o AS (SELECT DISTINCT person_id, condition_concept_id AS level FROM condition_occurrence WHERE condition_concept_id IN (2001, 2002, 2003, 2999)), r AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY level) AS rn FROM o),
c AS (SELECT CAST(s.level AS INT) AS level, count(r.person_id) AS n FROM (VALUES (2001), (2002), (2003), (2999)) s(level) LEFT JOIN r ON s.level = r.level AND rn <= 2 GROUP BY s.level) SELECT level, n + {_noise(_said("levels", "n", "CAST(level AS VARCHAR)"), 4.0)} AS n FROM c""")
def release_histogram(spark, d):
    cells = D.categorical(view(spark, d, "condition_occurrence"), "condition_concept_id", [2001, 2002, 2003, 2999], 2)
    return D.release(cells, ["level"], {"n": 2}, _SECRET, "levels", 0.5)


@query(f"""WITH pads AS (SELECT {_pads()}), o AS (SELECT avg(days_supply) AS v FROM drug_exposure WHERE days_supply IS NOT NULL GROUP BY person_id),
g AS (SELECT count(*) AS n, CAST(sum(floor((greatest(10.0, least(40.0, v)) - 10.0) / 30.0 * 1000 + 0.5)) AS BIGINT) AS s FROM o), r AS (SELECT n + {_noise(_said("supply", "n"), 2.0)} AS n, s + {_noise(_said("supply", "sum_grid"), 2000.0)} AS sum_grid FROM g)
SELECT n, sum_grid, CASE WHEN n > 0 THEN round(greatest(10, least(40, 10 + 30.0 * sum_grid / (n * 1000))), 6) END AS value FROM r""")
def release_mean(spark, d):
    return D.released_mean(view(spark, d, "drug_exposure"), "days_supply", 10.0, 40.0, _SECRET, "supply", 1.0).select("n", "sum_grid", *rounded("value"))


@query(f"""WITH pads AS (SELECT {_pads()}), g AS (SELECT count(CASE WHEN v THEN 1 END) AS num, count(*) AS den FROM (SELECT bool_or(days_supply > 45) AS v FROM drug_exposure GROUP BY person_id) x),
r AS (SELECT num + {_noise(_said("long", "num"), 4.0)} AS num, den + {_noise(_said("long", "den"), 4.0)} AS den FROM g) SELECT num, den, CASE WHEN den > 0 THEN round(greatest(0.0, least(1.0, num / CAST(den AS DOUBLE))), 6) END AS value FROM r""")
def release_rate(spark, d):
    return D.released_rate(view(spark, d, "drug_exposure"), F.col("days_supply") > 45, _SECRET, "long", 0.5).select("num", "den", *rounded("value"))


_GRIDS = {0: range(0, 100, 5), 1: range(0, 100, 10), 2: (0, 20, 40, 50, 55, 60, 80)}


def _policy(name: str, bands: dict[int, int]) -> None:
    def f(spark, d):
        persons = view(spark, d, "person").select("site_id", (F.lit(2000) - F.col("year_of_birth")).alias("age"))
        grids, own = N.grid_rows(spark, _GRIDS), spark.createDataFrame(list(bands.items()), "site_id int, band int")
        return N.pooled_ages(N.site_counts(persons, "age", grids, own), grids, own, SITES)

    f.__name__ = name
    common = [0, 20, 40, 50, 60, 80]
    rows = ", ".join(f"({a}, {b or 'NULL'})" for a, b in zip(common, [*common[1:], None], strict=True))
    edges = ", ".join(f"({s}, {a}, {b or 'NULL'})" for s, g in _GRIDS.items() for a, b in zip(g, [*list(g)[1:], None], strict=True))
    width = ", ".join(f"({s}, {b})" for s, b in bands.items())
    n = "CASE WHEN count(DISTINCT site_id) = 3 THEN CAST(sum(n) AS BIGINT) END" if len(set(bands.values())) == 1 else "CAST(NULL AS BIGINT)"
    query(f"""WITH own(site_id, f, t) AS (VALUES {edges}), w(site_id, band) AS (VALUES {width}), g(age_from, age_to) AS (VALUES {rows}),
c AS (SELECT p.site_id, f, CAST(floor(count(*) / max(band)) * max(band) AS BIGINT) AS n FROM person p JOIN own ON own.site_id = p.site_id AND 2000 - year_of_birth >= f AND (t IS NULL OR 2000 - year_of_birth < t) JOIN w ON w.site_id = p.site_id GROUP BY 1, 2)
SELECT age_from, age_to, {n} AS n FROM c JOIN g ON f >= age_from AND (age_to IS NULL OR f < age_to) GROUP BY 1, 2""")(f)


_policy("policy_common_ages", {0: 5, 1: 5, 2: 5})
_policy("policy_different_bands", {0: 5, 1: 10, 2: 5})
