"""Quality classifier by co-training of a content view and a metadata view."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import dropped, stage
from .words import _SPACE, mix, slices, strings, words

#: Most labelled rows that training uses (lowest hash of doc_id first), and rows that a
#: view's classifier hands to the other as labels in the last round, of all unlabelled ones.
LABELLED_ROWS, EXCHANGED = 10_000, 600
#: Hash buckets of the words of the content view, and of each field of the metadata view.
BUCKETS, FIELD = 1_024, 32
#: Rows whose views a task holds at once.
PART = 1_024
ROUNDS = 3
#: What a byte is: a bit for each class.
_IS = np.zeros(256, np.uint8)
SIGN, UPPER, OTHER, SPACE, DOT, HIGH = (1 << i for i in range(6))
_IS[list(b"#*$%&|<>!{}~^=_\\")] |= SIGN
_IS[65:91] |= UPPER
_IS[[i for i in range(256) if not (65 <= i < 91 or 97 <= i < 123)]] |= OTHER
_IS[_SPACE] |= SPACE
_IS[ord(".")] |= DOT
_IS[0x80:] |= HIGH
DENSE = 12


def _rates(top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    return np.divide(top, bottom, out=np.zeros(len(top)), where=bottom > 0)


def content(texts: pa.Array) -> np.ndarray:
    """The content view: word frequencies by hash bucket (square roots, unit length), and
    DENSE shares of signs, capitals, repeated and short words."""
    out = []
    for i, j in slices(texts, 1 << 19):
        w = words(texts[i:j])
        n, owner, h = len(w.first) - 1, w.owner(), w.hashes()
        count = w.counts().astype(float)
        bag = np.bincount(owner * BUCKETS + (h >> np.uint64(54)).astype(np.int64), minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float32)
        np.sqrt(bag, out=bag)
        bag /= np.maximum(1e-9, np.sqrt(count))[:, None]  # squares of the roots add up to the words
        size = (w.end - w.start).astype(float)
        what = _IS[w.data]
        length = np.diff(w.text).astype(float)
        per_word = lambda v, owner=owner, n=n: np.bincount(owner, v, minlength=n)
        per_byte = lambda c, w=w, what=what: np.diff(np.searchsorted(np.flatnonzero(what & c), w.text)).astype(float)
        solid, alpha, signs = length - per_byte(SPACE), length - per_byte(OTHER), per_byte(SIGN)
        ends, begins = (what[w.end - 1] & SIGN > 0, what[w.start] & SIGN > 0) if len(h) else (size > 0, size > 0)
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
        own = np.sort(owner.astype(np.uint64) << np.uint64(40) | mix(h) >> np.uint64(24))  # different words of a text differ in 40 bits
        first = np.ones(len(own), bool)
        first[1:] = own[1:] != own[:-1]
        distinct = np.bincount((own[first] >> np.uint64(40)).astype(np.int64), minlength=n)
        dense = [
            _rates(signs, solid), _rates(per_byte(UPPER), alpha), _rates(per_word(ends), count), _rates(per_word(same), count), _rates(distinct, count), np.minimum(1, _rates(per_word(size), count) / 20),
            _rates(per_word(size <= 3), count), _rates(per_word((size == 1) & begins), count), _rates(per_word(size > 20), count), _rates(per_byte(DOT), count), _rates(per_byte(HIGH), solid), (count == 0).astype(float),
        ]
        out.append(np.hstack([bag, 4 * np.stack(dense, axis=1)]).astype(np.float32))
    return np.concatenate(out) if out else np.zeros((0, BUCKETS + DENSE), np.float32)


def _field(values: list, salt: int) -> np.ndarray:
    made = pa.array(["" if v is None else str(v) for v in values], pa.string())
    w = np.array([hash_text(x, salt) for x in made.to_pylist()], np.int64)
    return np.eye(FIELD, dtype=np.float32)[w % FIELD] if len(values) else np.zeros((0, FIELD), np.float32)


def hash_text(text: str, salt: int) -> int:
    h = 1469598103934665603 ^ salt
    for b in text.encode():
        h = (h ^ b) * 1099511628211 & (1 << 63) - 1
    return h >> 20


def metadata(source: list, lang: list, n_chars: list, texts: pa.Array) -> np.ndarray:
    """The metadata view: source, language, size, and the layout of lines, each in
    intervals of its own; not a word of the text."""
    lines, longest, mean, twice = [], [], [], []
    for t in texts.to_pylist():
        all_of = t.encode().split(b"\n")
        some = [x for x in all_of if x.strip()]
        lines.append(len(some))
        longest.append(max(map(len, some), default=0))
        mean.append(sum(map(len, some)) / len(some) if some else 0)
        twice.append(1 - len(set(some)) / len(some) if some else 0)
    steps = lambda v: np.eye(FIELD, dtype=np.float32)[np.minimum(FIELD - 1, (2 * np.log2(1 + np.maximum(0, np.array(v, float)))).astype(int))] if len(v) else np.zeros((0, FIELD), np.float32)
    tens = np.eye(FIELD, dtype=np.float32)[(np.array(twice) * (FIELD - 1)).astype(int)] if len(twice) else np.zeros((0, FIELD), np.float32)
    return np.hstack([_field(source, 1), _field(lang, 2), steps([x or 0 for x in n_chars]), steps(lines), steps(longest), steps(mean), tens])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, start: np.ndarray | None = None, steps: int = 200, rate: float = 0.1, l2: float = 1e-4) -> np.ndarray:
    """Weights (bias last) of a logistic regression, by Adam on the rows of positive weight.
    Rows stay where they are, so no copy of x is made."""
    w = np.zeros(x.shape[1] + 1, np.float32) if start is None else start.copy()
    a, b = np.zeros_like(w), np.zeros_like(w)
    if not weight.sum():
        return w
    weight, y = (weight / weight.sum()).astype(np.float32), y.astype(np.float32)
    for t in range(1, steps + 1):
        error = (1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30))) - y) * weight
        g = np.append(error @ x, error.sum()) + l2 * w
        a, b = 0.9 * a + 0.1 * g, 0.999 * b + 0.001 * g * g
        w -= (rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return w


def _margin(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class Model:
    text: np.ndarray
    meta: np.ndarray
    scale: np.ndarray  #: of each view: factor and bias that calibrate its margin to log odds
    join: np.ndarray  #: weights of the two views' log odds, and a bias

    def margins(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.stack([_margin(a, self.text), _margin(b, self.meta)], axis=1)

    def score(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        odds = self.margins(a, b) * self.scale[:, 0] + self.scale[:, 1]
        return 1 / (1 + np.exp(-np.clip(_margin(odds, self.join), -30, 30)))


@dataclass
class Rows:
    """The views of some rows, and their labels."""

    a: np.ndarray
    b: np.ndarray
    y: np.ndarray


def learn(known: Rows, given: tuple[Rows, Rows], before: Model | None) -> Model:
    """The views' classifiers after a round: of the known rows but each fifth, and, at half
    the weight, of those given to either by the other."""
    fit = np.ones(len(known.y), bool)
    fit[4::5] = False  # held back to calibrate
    views = []
    for own, x, start in (("a", given[0], before and before.text), ("b", given[1], before and before.meta)):
        rows = np.concatenate([getattr(known, own)[fit], getattr(x, own)])
        weight = np.append(np.ones(int(fit.sum())), np.full(len(x.y), 0.5))
        views.append(_logistic(rows, np.append(known.y[fit], x.y), weight, start, steps=200 if before is None else 60))
    return Model(*views, np.tile([1.0, 0.0], (2, 1)), np.array([0.5, 0.5, 0]))


def calibrated(model: Model, known: Rows) -> Model:
    """Platt scaling of each view on the rows held back, then weights of their log odds."""
    use = np.arange(len(known.y))[4::5]
    if len(use) < 50 or not 0 < known.y[use].sum() < len(use):
        use = np.arange(len(known.y))
    both, y, one = model.margins(known.a[use], known.b[use]).astype(np.float32), known.y[use], np.ones(len(use))
    scale = np.stack([_logistic(both[:, [v]], y, one, np.array([1, 0], np.float32), steps=300, l2=1e-3) for v in (0, 1)])
    join = _logistic((both * scale[:, 0] + scale[:, 1]).astype(np.float32), y, one, np.array([0.5, 0.5, 0], np.float32), steps=300, l2=1e-3)
    return Model(model.text, model.meta, scale, join)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most PART rows at a time: a row's views are some thousand numbers."""
    for b in batches:
        for i in range(0, b.num_rows, PART):
            yield b.slice(i, PART)


def _views(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    texts = strings(b.column("text"))
    return content(texts), metadata(b.column("source").to_pylist(), b.column("lang").to_pylist(), b.column("n_chars").to_pylist(), texts)


def _packed(x: np.ndarray, kind) -> pa.Array:
    return pa.array([r.tobytes() for r in x.astype(kind)], pa.binary())


def _rows(t: pa.Table) -> Rows:
    """Rows of t (rank, y, a, b), by rank and label: the same whatever order tasks ended in."""
    t, n = t.combine_chunks(), t.num_rows
    order = np.lexsort((t.column("y").to_numpy(), t.column("rank").to_numpy()))
    raw = {c: b"".join(t.column(c).to_pylist()) for c in ("a", "b")}
    a = np.frombuffer(raw["a"], np.float16).reshape(n, BUCKETS + DENSE)[order].astype(np.float32)
    b = np.frombuffer(raw["b"], bool).reshape(n, 7 * FIELD)[order].astype(np.float32)
    return Rows(a, b, t.column("y").to_numpy()[order].astype(float))


def _fetched(chosen: DataFrame) -> Rows:
    """The views of chosen (doc_id, mark, y, text, lang, source, n_chars)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            x, y = _views(b)
            yield pa.RecordBatch.from_arrays([b.column("rank"), b.column("y"), _packed(x, np.float16), _packed(y, bool)], ["rank", "y", "a", "b"])

    return _rows(chosen.select(F.xxhash64("doc_id", "mark").alias("rank"), "y", "text", "lang", "source", "n_chars").mapInArrow(run, "rank long, y int, a binary, b binary").toArrow())


def _one_each(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of the rows of docs whose doc_id is wanted (a bounded table), one for each: that with
    the smallest mark, the hash of what the views read. So at most as many rows come to
    the driver, however often a doc_id is repeated."""
    rows = docs.join(F.broadcast(wanted), "doc_id")
    first = rows.groupBy("doc_id", "y").agg(F.min_by(F.struct("mark", "text", "lang", "source", "n_chars"), "mark").alias("r"))
    return first.select("doc_id", "y", "r.*")


class Surest:
    """The n rows of a class of which a view's classifier is surest, of all rows seen so far:
    at most one of a margin, that with the smallest rank. low: the class of low margins."""

    def __init__(self, n: int, low: bool):
        self.n, self.sign = n, 1.0 if low else -1.0
        self.rows: tuple[np.ndarray, ...] = ()

    def add(self, margin: np.ndarray, *columns: np.ndarray) -> None:
        """Rows of (margin, rank, others)."""
        use = np.flatnonzero(self.sign * margin < 0)
        if self.rows and len(self.rows[0]) >= self.n:
            use = use[self.sign * margin[use] <= self.sign * self.rows[0][-1]]
        if not self.n or not len(use):
            return
        new = [c[use] for c in (margin, *columns)]
        if self.rows:
            new = [np.concatenate(p) for p in zip(self.rows, new, strict=True)]
        order = np.lexsort((new[1], self.sign * new[0]))
        first = np.ones(len(order), bool)
        first[1:] = np.diff(new[0][order]) != 0
        self.rows = tuple(c[order[first][: self.n]] for c in new)


def _limits(n: int, share: float) -> list[tuple[int, int, int]]:
    """(view, class, rows): how many of each class a view hands over."""
    return [(v, y, round(n * (share if y else 1 - share))) for v in (0, 1) for y in (0, 1)]


def surest(docs: DataFrame, model: Model, n: int, share: float) -> list[Rows]:
    """The rows of docs (text, lang, source, n_chars, rank) of which each view's classifier is
    surest, n a view, in the classes' shares. Rows with the same margin count once, so
    copies don't fill a class.

    Rows are scored where they are, and each task keeps its own surest ones, at most 2 * n,
    with their views; so texts are read once and stay where they are, and n rows a view
    come to the driver.
    """
    limits = _limits(n, share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {(v, y): Surest(many, y == 0) for v, y, many in limits}
        for b in _parts(batches):
            x, z = _views(b)
            m = model.margins(x, z).astype(float).round(4)  # sums differ in their last digits from batch to batch
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            for (v, _), own in best.items():
                own.add(m[:, v], rank, x, z)
        for (v, y), own in best.items():
            if own.rows:
                margin, rank, x, z = own.rows
                k = len(margin)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, v, np.int32)), pa.array(np.full(k, y, np.int32)), pa.array(margin), pa.array(rank), _packed(x, np.float16), _packed(z, bool)], ["view", "y", "m", "rank", "a", "b"])

    kept = stage(docs.select("text", "lang", "source", "n_chars", "rank").mapInArrow(run, "view int, y int, m double, rank long, a binary, b binary"), "surest")
    one = kept.groupBy("view", "y", "m").agg(F.min("rank").alias("rank"), F.min_by(F.struct("a", "b"), "rank").alias("r"))
    parts = {}
    for v, y, many in limits:
        own = one.where((F.col("view") == v) & (F.col("y") == y))
        parts[v, y] = own.orderBy(F.col("m").desc() if y else F.col("m").asc()).limit(many).select("rank", "y", "r.a", "r.b").toArrow()
    dropped(kept)
    return [_rows(pa.concat_tables([parts[v, 0], parts[v, 1]])) for v in (0, 1)]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from labels (doc_id, quality) and docs, by co-training.

    The views' classifiers learn from at most LABELLED_ROWS labelled rows, one row of a
    doc_id; all other rows count as unlabelled. In each round every unlabelled row is
    scored where it is; the rows of which either view is surest, up to EXCHANGED of all of
    them, become labels of the other one. What comes to the driver is the views of the
    labelled and of the exchanged rows. Conflicting labels: the lowest. A fifth of the
    labelled rows calibrates the views and weighs them. Texts are read once for the labelled
    rows and once a round.
    """
    read = [F.col(c) for c in ("text", "lang", "source", "n_chars")]
    docs = docs.where("doc_id is not null").select("doc_id", *read, F.xxhash64(*read).alias("mark"))
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("y"))
    picked = stage(marks.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED_ROWS), "picked")
    known = _fetched(_one_each(docs, picked))
    none = Rows(known.a[:0], known.b[:0], known.y[:0])
    model = learn(known, (none, none), None)
    share = float(known.y.mean()) if len(known.y) else 0.5
    others = docs.join(F.broadcast(picked.select("doc_id")), "doc_id", "left_anti").withColumn("rank", F.xxhash64("doc_id", "mark"))  # LABELLED_ROWS ids at most
    for turn in range(ROUNDS if len(known.y) else 0):
        given = surest(others, model, EXCHANGED * (turn + 1) // ROUNDS, share)
        model = learn(known, (given[1], given[0]), model)
    return calibrated(model, known)


def _scored(docs: DataFrame, labels: DataFrame, columns: list[str], keep: bool, least: float) -> DataFrame:
    model = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            score = model.score(*_views(b))
            out = b.select(columns)
            yield out.filter(pa.array(score >= least)) if keep else pa.RecordBatch.from_arrays([*out.columns, pa.array(score.astype(float))], [*columns, "score"])

    need = list(dict.fromkeys([*columns, "text", "lang", "source", "n_chars"]))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select(*need).mapInArrow(run, kinds if keep else f"{kinds}, score double")


def score(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """One row per document: (doc_id, score, kept); score: how likely it is good; kept:
    score >= least. Null and empty texts are scored by their metadata and an empty
    content; a null source or language is a value of its own. Without labels all score 0.5
    and are kept. Equal rows score alike. Of rows that repeat a labelled doc_id one is
    learnt from, all are scored.
    """
    return _scored(docs, labels, ["doc_id"], False, least).withColumn("kept", F.col("score") >= least)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs that score at least ``least``, with their columns."""
    return _scored(docs, labels, docs.columns, True, least)
