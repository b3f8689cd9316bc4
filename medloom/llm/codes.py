"""Vector code compression: product codebooks by Lloyd's rounds with Hamerly's bounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .shared import dropped, small, stage

#: Parts of a vector, entries of each part's codebook, rounds, and integer steps of 1.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1_024
#: Vectors whose distances to all entries a task holds at once.
BLOCK = 2_048
#: Whole-number components must be below the first, and a part not wider than the second, so
#: that squared distances fit a long.
LARGEST, WIDEST = 1 << 25, 1 << 11


@dataclass
class Books:
    entries: np.ndarray  #: part, entry, position: whole numbers
    moved: np.ndarray  #: part, entry: how far each went in the last update
    fresh: bool = True  #: no bounds yet


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries, both whole numbers."""
    most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.float64 if 4 * x.shape[1] * int(most) ** 2 < 1 << 53 else np.int64  # doubles are exact up to there
    a, b = x.astype(kind), entries.astype(kind)
    return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)


def _own(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to the entry beside it."""
    d = x - entries
    return (d * d).sum(axis=1)


def assign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray | None, code: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code, upper, lower, scanned): the nearest entry of each row, ties to the lower index.

    upper bounds the distance to the row's entry, lower that to any other. After an update
    they widen by what entries moved; where upper stays strictly below lower (by more than
    rounding can hide) no other entry is as near. Else upper is made exact, and if that
    doesn't help, all entries are scanned. moved None: no bounds yet.
    """
    code, upper, lower = code.copy(), upper.copy(), lower.copy()
    less = lambda u, v: u * (1 + 1e-9) + 1e-6 < v
    if moved is None:
        open_ = np.arange(len(x))
    else:
        order = np.argsort(moved)
        far, next_ = int(order[-1]), moved[order[-2]] if len(order) > 1 else 0.0
        upper += moved[code]
        lower -= np.where(code == far, next_, moved[far])
        open_ = np.flatnonzero(~less(upper, lower))
        upper[open_] = np.sqrt(_own(x[open_], entries[code[open_]]))
        open_ = open_[~less(upper[open_], lower[open_])]
    for i in range(0, len(open_), BLOCK):
        rows = open_[i : i + BLOCK]
        d = squared(x[rows], entries)
        best = d.argmin(axis=1)
        code[rows] = best
        upper[rows] = np.sqrt(d[np.arange(len(rows)), best])
        d[np.arange(len(rows)), best] = np.iinfo(np.int64).max
        lower[rows] = np.sqrt(d.min(axis=1).astype(float))
    scanned = np.zeros(len(x), bool)
    scanned[open_] = True
    return code, upper, lower, scanned


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width).astype(kind, copy=False)


def _lists(m: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel(), kind))


def whole(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, x): the rows with a vector of finite components, each component as the
    integer below SCALE times it. Vectors of another length than most, or whose length PARTS
    doesn't divide, and components from LARGEST / SCALE on are errors."""
    v = F.col("embedding")
    ok = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    fits = F.forall(v, lambda c: F.abs(c) < LARGEST // SCALE)
    ints = F.when(fits, F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("int"))).otherwise(F.raise_error(F.lit(f"a component is not below {LARGEST // SCALE}")).cast("array<int>"))
    return embeddings.where(F.coalesce(ok, F.lit(False))).select("vec_id", "label", ints.alias("x"))


def _round(rows: DataFrame, books: Books, width: int) -> DataFrame:
    """rows with new code, upper, lower (arrays by part) and scans, the number of parts of
    which all entries were scanned so far."""
    part = width // PARTS
    shape = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ("vec_id", "label", "x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            x = _matrix(b.column("x"), width, np.int64)
            if books.fresh:
                code, upper, lower, scans = np.zeros((n, PARTS), np.int64), np.zeros((n, PARTS)), np.zeros((n, PARTS)), np.zeros(n, np.int64)
            else:
                code, upper, lower = _matrix(b.column("code"), PARTS, np.int64), _matrix(b.column("upper"), PARTS, np.float64), _matrix(b.column("lower"), PARTS, np.float64)
                scans = b.column("scans").to_numpy()
            new = [assign(x[:, p * part : (p + 1) * part], books.entries[p], None if books.fresh else books.moved[p], code[:, p], upper[:, p], lower[:, p]) for p in range(PARTS)]
            code, upper, lower, scanned = (np.stack(c, axis=1) for c in zip(*new, strict=True))
            error = sum(_own(x[:, p * part : (p + 1) * part], books.entries[p][code[:, p]]) for p in range(PARTS))
            cols = [b.column("vec_id"), b.column("label"), b.column("x"), _lists(code, pa.int16()), _lists(upper, pa.float64()), _lists(lower, pa.float64()), pa.array(scans + scanned.sum(axis=1), pa.int64()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["vec_id", "label", "x", "code", "upper", "lower", "scans", "error"])

    return rows.mapInArrow(run, f"{shape}, code array<short>, upper array<double>, lower array<double>, scans long, error long")


def _updated(rows: DataFrame, books: Books, width: int) -> Books:
    """Entries at the floor of the mean of their parts; those without parts stay. Sums are
    taken in each task first: at most PARTS * ENTRIES rows of them come to the driver."""
    part = width // PARTS
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.get("code", F.lit(p)).alias("c"), F.slice("x", 1 + p * part, part).alias("x")) for p in range(PARTS)]))
    sums = [F.sum(F.get("e.x", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(part)]
    entries = books.entries.copy()
    for r in rows.select(each.alias("e")).groupBy("e.p", "e.c").agg(F.count("*").alias("n"), *sums).collect():
        entries[r[0], r[1]] = [s // r[2] for s in r[3:]]
    d = (entries - books.entries).astype(float)
    return Books(entries, np.sqrt((d * d).sum(axis=2)), False)


def trained(embeddings: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The codes of embeddings (vec_id, embedding, label), a row for each that isn't dropped:
    (vec_id, code, error, label, scans); and the codebooks, by part, entry and position.

    Rows whose vector is null or holds a null or non-finite component are dropped (also an
    empty table gives no rows); repeated rows and vec_ids each give one. Each part's
    codebook begins with that part of the ``entries`` smallest vec_ids (a null one last;
    ties by vector). Each round assigns all parts to the nearest entry, ties to the lower
    index, and moves each entry to the floor of its parts' mean; at last parts are assigned
    again. code: two hex digits a part (entries is 256 at most); error: squared distances,
    summed over parts; scans: how often in all rounds all entries were scanned for a part of
    the row.

    Bounds stand beside the vectors in the table of a round, which is written to the shared
    folder; the one before is deleted then. The driver holds the codebooks only.
    """
    first = stage(whole(embeddings), "vectors")
    start = first.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    width = len(start[0].x) if start else 0
    if width % PARTS or width // PARTS > WIDEST or not first.where(F.size("x") != width).isEmpty():
        raise ValueError(f"vectors must have one length that {PARTS} divides, up to {PARTS * WIDEST}")
    book = np.array([r.x for r in start], np.int64).reshape(len(start), PARTS, width // PARTS).transpose(1, 0, 2)
    books, now = Books(book, np.zeros(book.shape[:2])), first
    for turn in range(rounds + 1):
        new = stage(_round(now, books, width), "codes")
        dropped(now)
        now = new
        if turn < rounds and start:
            books = _updated(now, books, width)
    hexed = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c.cast("long")), 2, "0"))), "")
    return now.select("vec_id", hexed.alias("code"), "error", "label", "scans"), books.entries


def compress(embeddings: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """What ``trained`` gives, with label_error, the error summed over rows of equal label,
    nulls together, and codebooks_sha256, of all entries' components joined by commas."""
    found, books = trained(embeddings, entries, rounds)
    by_label = small(stage(found.groupBy("label").agg(F.sum("error").alias("label_error")), "labels"), 32)
    out = found.join(by_label, found["label"].eqNullSafe(by_label["label"])).drop(by_label["label"])
    return out.withColumn("codebooks_sha256", F.lit(hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()))


def decoded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """rows (vec_id, code) with ``x``, the entries that the code names, one after the other:
    the vector in steps of 1 / SCALE, within error."""
    flat = [[int(v) for v in e] for p in books for e in p]
    n = books.shape[1]
    table = F.broadcast(rows.sparkSession.createDataFrame([(flat,)], "book array<array<int>>"))  # one row, PARTS * ENTRIES entries
    at = lambda p: F.get("book", (F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int") + p * n))
    return rows.crossJoin(table).withColumn("x", F.concat(*[at(p) for p in range(PARTS)])).drop("book")


def _oracle() -> str:
    """SQL of ``compress``: distances of all parts to all entries in every round."""
    ctes = [
        "kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)) AS x FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)",
        f"parts AS (SELECT row, p, list_slice(x, (p * len(x) // {PARTS} + 1)::BIGINT, ((p + 1) * len(x) // {PARTS})::BIGINT) AS x FROM kept, range({PARTS}) r(p))",
        f"book0 AS (SELECT p, row - 1 AS e, x FROM parts WHERE row <= {ENTRIES})",
    ]
    for turn in range(ROUNDS + 1):
        gap = "(list_inner_product(a.x, a.x) - 2 * list_inner_product(a.x, b.x) + list_inner_product(b.x, b.x))"
        ctes.append(f"near{turn} AS MATERIALIZED (SELECT a.row, a.p, min(struct_pack(d := {gap}, e := b.e)) AS m, any_value(a.x) AS x FROM parts a JOIN book{turn} b ON a.p = b.p GROUP BY a.row, a.p)")
        if turn < ROUNDS:
            ctes.append(f"flat{turn} AS (SELECT p, m.e AS e, i, floor(sum(x[i]) / count(*)) AS v FROM near{turn}, range(1, 1000) r(i) WHERE i <= len(x) GROUP BY p, m.e, i)")
            ctes.append(f"mean{turn} AS (SELECT p, e, list(v ORDER BY i) AS x FROM flat{turn} GROUP BY p, e)")
            ctes.append(f"book{turn + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{turn} b LEFT JOIN mean{turn} m ON b.p = m.p AND b.e = m.e)")
    ctes.append(f"done AS (SELECT row, string_agg(lpad(lower(to_hex(m.e)), 2, '0'), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM near{ROUNDS} GROUP BY row)")
    ctes.append(f"said AS (SELECT sha256(string_agg(list_aggregate(list_transform(x, lambda c: c::BIGINT::VARCHAR), 'string_agg', ','), ',' ORDER BY p, e)) AS s FROM book{ROUNDS})")
    return f"WITH {', '.join(ctes)} SELECT vec_id, code, error, label, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, s AS codebooks_sha256 FROM done JOIN kept ON done.row = kept.row, said"


ORACLE = _oracle()
