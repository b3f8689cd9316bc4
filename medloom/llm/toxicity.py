"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stage
from .words import mix, running, slices, strings, words

#: Labelled rows fitted at most (those with the lowest hash of doc_id).
TRAIN_ROWS = 20_000
BITS, FACTORS = 22, 8
#: Bytes of the beginnings of words that are terms of their own, beside the whole word.
STEMS = (4, 5, 6)
#: Documents that must hold a term, and chi-square of a term with the label, at least.
LEAST_DOCS, LEAST_CHI2 = 4, 25.0
_EDGE = np.zeros(256, bool)
_EDGE[list(b".,;:!?#*$%&|<>()[]{}\"'`~_-+=/\\")] = True


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of the terms of texts; a term may come again. Terms are the words,
    A-Z in lower case, without signs at their ends, and their first STEMS bytes."""
    w = words(texts, lower=True)
    start, end = w.start.copy(), w.end.copy()
    for _ in range(8):
        long = end - start > 1
        end -= _EDGE[w.data[end - 1]] & long
        start += _EDGE[w.data[start]] & (end - start > 1)
    whose, owners, buckets = w.owner(), [], []
    for i, j in w.blocks():
        base = w.start[i]
        sums, down = running(w.data[base : w.end[j - 1]])
        s, e, owner = start[i:j] - base, end[i:j] - base, whose[i:j]
        found = [(owner, mix((sums[e] - sums[s]) * down[s]))]
        for n in STEMS:
            has = np.flatnonzero(e - s >= n)
            a = s[has]
            found.append((owner[has], mix((sums[a + n] - sums[a]) * down[a] + np.uint64(n))))
        owners += [x for x, _ in found]
        buckets += [(x >> np.uint64(64 - BITS)).astype(np.int32) for _, x in found]
    return (np.concatenate(owners), np.concatenate(buckets)) if owners else (np.zeros(0, np.int64), np.zeros(0, np.int32))


@dataclass
class Machine:
    buckets: np.ndarray  #: of the terms kept, in order
    bias: float
    weight: np.ndarray
    factor: np.ndarray  #: terms x FACTORS

    def rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(text, term): which kept terms each text holds, each once."""
        known = np.full(1 << BITS, -1, np.int32)
        known[self.buckets] = np.arange(len(self.buckets))
        out = []
        for i, j in slices(texts):
            owner, bucket = _terms(texts[i:j])
            term = known[bucket]
            hit = term >= 0
            out.append(np.unique((owner[hit] + i) * len(self.buckets) + term[hit]))
        pairs = np.concatenate(out) if out else np.zeros(0, np.int64)
        n = max(1, len(self.buckets))
        return pairs // n, pairs % n

    def margin(self, n: int, owner: np.ndarray, term: np.ndarray) -> np.ndarray:
        """bias + sum of weights + sum over pairs of terms of the product of their factors."""
        total = np.full(n, self.bias)
        np.add.at(total, owner, self.weight[term])
        sums, squares = np.zeros((n, self.factor.shape[1])), np.zeros(n)
        np.add.at(sums, owner, self.factor[term])
        np.add.at(squares, owner, (self.factor[term] ** 2).sum(axis=1))
        return total + 0.5 * ((sums**2).sum(axis=1) - squares)

    def score(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(len(texts), *self.rows(texts)), -30, 30)))


def _fit(buckets: np.ndarray, rows: list[np.ndarray], label: np.ndarray, epochs: int = 40, rate: float = 0.05, l2: float = 1e-4) -> Machine:
    """Adam on the logistic loss, in batches drawn in a fixed order."""
    rng = np.random.default_rng(7)
    share = float(np.clip(label.mean() if len(label) else 0.5, 1e-3, 1 - 1e-3))
    m = Machine(buckets, float(np.log(share / (1 - share))), np.zeros(len(buckets)), rng.normal(0, 0.05, (len(buckets), FACTORS)))
    if not len(buckets) or not len(label):
        return m
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in (("weight", m.weight), ("factor", m.factor), ("bias", np.zeros(1)))}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for at in range(0, len(order), 256):
            pick = order[at : at + 256]
            owner = np.repeat(np.arange(len(pick)), [len(rows[i]) for i in pick])
            term = np.concatenate([rows[i] for i in pick])
            error = (1 / (1 + np.exp(-np.clip(m.margin(len(pick), owner, term), -30, 30))) - label[pick]) / len(pick)
            sums = np.zeros((len(pick), FACTORS))
            np.add.at(sums, owner, m.factor[term])
            gw, gf = l2 * m.weight, l2 * m.factor
            np.add.at(gw, term, error[owner])
            np.add.at(gf, term, error[owner][:, None] * (sums[owner] - m.factor[term]))
            step += 1
            for k, g in (("weight", gw), ("factor", gf), ("bias", np.array([error.sum()]))):
                a, b = state[k]
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                change = rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
                if k == "bias":
                    m.bias -= float(change[0])
                else:
                    getattr(m, k).__isub__(change)
    return m


def _associated(held: DataFrame) -> list[tuple[int, bool]]:
    """(bucket, whether it speaks for the label) of the terms of held (text, toxic) that stand
    in at least LEAST_DOCS rows and have a chi-square with the label of at least LEAST_CHI2."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, toxic = strings(b.column("text")), b.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in slices(texts, 4 << 20):
                owner, bucket = _terms(texts[i:j])
                pairs = np.unique((owner.astype(np.int64) << BITS) | bucket.astype(np.int64))
                own, inverse = np.unique(pairs & ((1 << BITS) - 1), return_inverse=True)
                bad = toxic[i:j][pairs >> BITS]
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.bincount(inverse, bad).astype(np.int64)), pa.array(np.bincount(inverse, 1 - bad).astype(np.int64))], ["bucket", "bad", "good"])

    size = held.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad")).first()
    n, bad = size.n, size.bad
    counts = held.mapInArrow(count, "bucket long, bad long, good long").groupBy("bucket").agg(F.sum("bad").alias("a"), F.sum("good").alias("b"))
    a, b, c, d = F.col("a").cast("double"), F.col("b").cast("double"), F.lit(float(bad)) - F.col("a"), F.lit(float(n - bad)) - F.col("b")
    chi2 = F.coalesce(F.try_divide(n * (a * d - b * c) * (a * d - b * c), (a + b) * (c + d) * (a + c) * (b + d)), F.lit(0.0))
    found = counts.where((a + b >= LEAST_DOCS) & (chi2 >= LEAST_CHI2)).select("bucket", (a * d > b * c).alias("speaks"))
    return [(r.bucket, r.speaks) for r in found.collect()]  # few beside the rows: each stands in LEAST_DOCS of them


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    """A machine learnt from labels (doc_id, toxic) and the texts of docs.

    Terms are those that are associated with the label in the labelled texts, and those that
    are in the texts that hold a term which speaks for it, however many they are: so a term
    that is as common in clean texts as in toxic ones is found by what it adds to others.
    They are counted in Spark. What comes to the driver are their buckets, and for at most
    TRAIN_ROWS rows which of these their texts hold. Of rows that repeat a doc_id, that
    with the smallest hash of its text is learnt from. Conflicting labels of a doc_id: the
    highest; null labels are none.
    """
    picked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    picked = stage(picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS), "picked")
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most TRAIN_ROWS ids
    held = stage(rows.groupBy("doc_id", "toxic").agg(F.min_by(F.struct("text"), F.xxhash64("text")).alias("r")).select("doc_id", "toxic", "r.text"), "labelled")

    def shaped(buckets: list[int]) -> Machine:
        return Machine(np.array(sorted(buckets), np.int64), 0.0, np.zeros(len(buckets)), np.zeros((len(buckets), FACTORS)))

    first = _associated(held)
    speaking = shaped([x for x, speaks in first if speaks])

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            some = np.zeros(x.num_rows, bool)
            some[speaking.rows(strings(x.column("text")))[0]] = True
            yield x.filter(pa.array(some))

    second = _associated(stage(held.mapInArrow(holding, held.schema), "speaking")) if len(speaking.buckets) else []
    shape = shaped(list({x for x, _ in first + second}))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            owner, term = shape.rows(strings(x.column("text")))
            lists = np.split(term, np.cumsum(np.bincount(owner, minlength=x.num_rows))[:-1])
            yield pa.RecordBatch.from_arrays([x.column("doc_id"), x.column("toxic"), pa.array([v.tolist() for v in lists], pa.list_(pa.int32()))], ["doc_id", "toxic", "terms"])

    kind = held.schema["doc_id"].dataType.simpleString()
    rows = held.mapInArrow(mark, f"doc_id {kind}, toxic int, terms array<int>").orderBy("doc_id", "terms").collect()
    return _fit(shape.buckets, [np.array(r.terms, np.int64) for r in rows], np.array([r.toxic for r in rows], float))


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learnt from: crc32 of doc_id as text divides by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: (doc_id, held_out, score, predicted).

    score: how likely the text is toxic, by a machine fitted on the labelled rows that
    are not held out; of a document it depends on its text alone. A text without kept
    terms (so an empty or null one) gets the machine's bias. No labels: 0.5 for all.
    """
    machine = fit(docs, labels.where(~held_out()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(machine.score(strings(b.column("text"))))], ["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
