"""Quality rules whose cutoffs keep the risk of rejecting good documents below a bound."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stage
from .words import _SPACE, mix, runs, slices, strings, whole_runs, words

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: Rules in this order: a document is suspect the more, the higher the value; with the
#: cutoffs that are tried, the same at every size.
RULES: dict[str, list[float]] = {
    "symbols": [i / 100 for i in range(1, 33)],
    "dup_lines": [i / 32 for i in range(1, 33)],
    "repeats": [i / 32 for i in range(1, 33)],
    "long_words": [5.0 + i / 4 for i in range(32)],
    "short_words": [-5.0 + i / 8 for i in range(32)],
}


def _statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")}
    for i, j in slices(texts):
        w = words(texts[i:j])
        per_text = lambda mask, w=w: np.diff(np.append(0, np.cumsum(mask))[w.text])
        out["n_words"].append(w.counts())
        out["word_chars"].append(per_text(~_SPACE[w.data] & ((w.data & 0xC0) != 0x80)))
        out["n_symbols"].append(per_text(_SYMBOL[w.data]))
        lines = [[x for x in t.encode().split(b"\n") if x.strip()] for t in texts[i:j].to_pylist()]
        out["n_lines"].append(np.array([len(x) for x in lines]))
        out["n_dup_lines"].append(np.array([len(x) - len(set(x)) for x in lines]))
        h, owner = w.hashes(), w.owner()
        at = np.flatnonzero(whole_runs(w.first, 3))
        again = np.zeros(len(h) + 1, bool)
        if len(at):
            _, back, count = np.unique(mix(runs(h, 3)[at] ^ mix(owner[at].astype(np.uint64))), return_inverse=True, return_counts=True)
            found = at[count[back] > 1]
            for k in range(3):
                again[found + k] = True
        out["n_repeat_words"].append(np.diff(np.append(0, np.cumsum(again[:-1]))[w.first]))
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}


_FIELDS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def statistics(docs: DataFrame, *also: str) -> DataFrame:
    """doc_id, the columns ``also``, and statistics of each whole text (null: empty).

    A word is what stands between ASCII white space; word_chars counts code points in
    words, n_symbols the characters #*$%&|<>, n_lines the lines with a word, n_dup_lines
    those of them that equal an earlier one, n_repeat_words the words in 3-word windows
    that the text holds twice or more.
    """
    kept = ["doc_id", *also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = _statistics(strings(b.column("text")))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *(pa.array(s[k].astype(np.int64)) for k in _FIELDS)], [*kept, *_FIELDS])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.select(*kept, "text").mapInArrow(run, f"{kinds}, " + ", ".join(f"{k} long" for k in _FIELDS))


def values() -> dict[str, Column]:
    """The value of each rule."""
    per = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    mean = per("word_chars", "n_words")
    return {"symbols": per("n_symbols", "word_chars"), "dup_lines": per("n_dup_lines", "n_lines"), "repeats": per("n_repeat_words", "n_words"), "long_words": mean, "short_words": -mean}


def lower_tail(k: int, n: int, p: float) -> float:
    """P(at most k of n) at probability p, exactly (in floating point)."""
    if k >= n:
        return 1.0
    i = np.arange(1, k + 1, dtype=float)
    logs = n * math.log1p(-p) + np.append(0.0, np.cumsum(np.log((n - i + 1) / i) + math.log(p / (1 - p))))
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum())) if top > -700 else 0.0


def cutoffs(stats: DataFrame, labels: DataFrame, stratum: str, risk: float, error: float) -> DataFrame:
    """(stratum, symbols, dup_lines, ...): the cutoff of each rule; null where none is safe.

    labels: (doc_id, quality). On the labelled good documents of a stratum, a cutoff is
    safe if the exact (Clopper-Pearson) upper bound of its share of rejected ones is at
    most risk / number of rules; the lowest safe one is taken. Bounds hold together at
    level 1 - error: those of a rule in a stratum are at error / (rules x strata), after
    Bonferroni. A rule's cutoffs are tested from the highest down to the first that
    fails, a fixed sequence, which needs no further correction; as a lower cutoff rejects
    no fewer documents, this is the lowest one that passes. What is collected by stratum
    is a histogram of fixed size.
    """
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    strata = max(1, stats.select(stratum).distinct().count())
    each = error / (len(RULES) * strata)
    bins = [F.struct(F.lit(r).alias("rule"), sum((v > F.lit(t)).cast("int") for t in RULES[r]).alias("above")) for r, v in values().items()]
    held = stats.join(good, "doc_id").select(stratum, F.explode(F.array(*bins)).alias("x")).groupBy(stratum, "x.rule", "x.above").agg(F.count("*").alias("n"))
    grid, rules = {r: sorted(t) for r, t in RULES.items()}, list(RULES)

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        row = {stratum: pdf[stratum].iloc[0]}
        for rule in rules:
            own = pdf[pdf.rule == rule]
            total = int(own.n.sum())
            row[rule] = None
            for i, cutoff in enumerate(grid[rule]):
                rejected = int(own.n[own.above > i].sum())
                if lower_tail(rejected, total, risk / len(rules)) <= each:
                    row[rule] = cutoff
                    break
        return pd.DataFrame([row])

    kind = stats.schema[stratum].dataType.simpleString()
    return held.groupBy(stratum).applyInPandas(choose, f"`{stratum}` {kind}, " + ", ".join(f"{r} double" for r in rules))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """doc_id with statistics, base_failed, and kept: false if base_failed or a value is
    above its stratum's cutoff.

    base_failed: fewer than 50 words, or over half of them in repeated 3-word windows. In
    a stratum (null is one) with too few labels for a bound, no rule rejects. Without
    labels only base_failed does. Repeated rows are judged alike; a null or empty text
    fails the base rule. Of docs only doc_id, text and the stratum are read.
    """
    stats = stage(statistics(docs, stratum), "statistics")
    cuts = stage(cutoffs(stats, labels, stratum, risk, error), "cutoffs").toDF("own_stratum", *(f"cut_{r}" for r in RULES))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    over = F.lit(False)
    for r, v in values().items():
        over = over | F.coalesce(v > F.col(f"cut_{r}"), F.lit(False))
    out = stats.join(cuts, F.col(stratum).eqNullSafe(F.col("own_stratum")), "left").withColumn("base_failed", failed).withColumn("kept", ~failed & ~over)
    return out.select("doc_id", *_FIELDS, "base_failed", "kept")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM d),
a AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM g),
e AS (SELECT r, count(DISTINCT j)::BIGINT AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM a WHERE n > 1) GROUP BY r),
l AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
s AS (SELECT r, doc_id, lang, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM l LEFT JOIN e USING (r)),
v AS (SELECT *, coalesce(n_symbols / nullif(word_chars, 0), 0)::DOUBLE AS symbols, coalesce(n_dup_lines / nullif(n_lines, 0), 0)::DOUBLE AS dup_lines, coalesce(n_repeat_words / nullif(n_words, 0), 0)::DOUBLE AS repeats,
        coalesce(word_chars / nullif(n_words, 0), 0)::DOUBLE AS long_words FROM s),
u AS (SELECT r, doc_id, lang, unnest([{'rule': 1, 'x': symbols}, {'rule': 2, 'x': dup_lines}, {'rule': 3, 'x': repeats}, {'rule': 4, 'x': long_words}, {'rule': 5, 'x': -long_words}], recursive := true) FROM v),
c AS (SELECT rule, CASE rule WHEN 1 THEN (i + 1) / 100.0::DOUBLE WHEN 2 THEN (i + 1) / 32.0::DOUBLE WHEN 3 THEN (i + 1) / 32.0::DOUBLE WHEN 4 THEN 5 + i / 4.0::DOUBLE ELSE -5 + i / 8.0::DOUBLE END AS cut FROM range(1, 6) a(rule), range(32) b(i)),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
n AS (SELECT lang, rule, cut, count(*)::BIGINT AS n, count(*) FILTER (x > cut)::BIGINT AS k FROM u JOIN good USING (doc_id) JOIN c USING (rule) GROUP BY lang, rule, cut),
b AS (SELECT lang, rule, min(cut) AS cut FROM n WHERE k < n
        AND list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.02::DOUBLE / 5) + (n - i) * ln(1 - 0.02::DOUBLE / 5))))
        <= 0.05::DOUBLE / (5 * (SELECT count(*) FROM (SELECT DISTINCT lang FROM documents))) GROUP BY lang, rule),
o AS (SELECT DISTINCT u.r FROM u JOIN b ON u.lang IS NOT DISTINCT FROM b.lang AND u.rule = b.rule AND u.x > b.cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND o.r IS NULL AS kept FROM s LEFT JOIN o USING (r)
"""
