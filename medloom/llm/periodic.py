"""Periodic runs of words, found lag by lag on bit planes of word ids."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .words import WORD, runs, slices, strings

#: A run is at least so long: in words, and in periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Up to so many lags each is looked at; of more, those at which some gram repeats.
ALL_LAGS = 128
#: Planes after which a lag without a sufficiently long stretch is given up.
FIRST_PLANES = 6

_SPACED = re.compile(WORD)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
Run = tuple[int, int, int]  #: start, length, period


def planes(ids: np.ndarray) -> list[int]:
    """Plane b is an integer whose bit i is bit b of ids[i]."""
    bits = max(1, int(ids.max()).bit_length())
    return [int.from_bytes(np.packbits((ids >> b & 1).astype(np.uint8), bitorder="little").tobytes(), "little") for b in range(bits)]


def _stretches(x: int, least: int) -> int:
    """Bits i of x from which on least bits are set: shifted by 1, 2, 4 ... and ANDed."""
    have = 1
    while x and have < least:
        step = min(have, least - have)
        x &= x >> step
        have += step
    return x


def at_lag(rows: list[int], n: int, lag: int) -> list[tuple[int, int]]:
    """(start, length) of the maximal stretches of words that agree with those lag further
    on and are long enough for a run; length counts the words of the run."""
    least, whole, apart = max(LEAST_WORDS - lag, (LEAST_PERIODS - 1) * lag), (1 << (n - lag)) - 1, 0
    for some in (rows[:FIRST_PLANES], rows[FIRST_PLANES:]):
        for p in some:
            apart |= p ^ (p >> lag)
        found = _stretches(whole ^ (apart & whole), least)
        if not found:
            return []
    bits = np.unpackbits(np.frombuffer(found.to_bytes((n - lag + 7) // 8, "little"), np.uint8), bitorder="little")
    edge = np.flatnonzero(np.diff(bits, prepend=0, append=0)).reshape(-1, 2)
    return [(s, e - s + least - 1 + lag) for s, e in edge.tolist()]


def lags_with_repeats(ids: np.ndarray, size: int, known: list[Run]) -> np.ndarray:
    """The lags from size to 2 * size - 1 at which a run is possible.

    A run of such a period holds, at a multiple of size, a gram of size words and its copy a
    period on; so only lags at which such a gram repeats count. Where a run of a smaller
    period covers the gram, one that covers the copy too leaves no new period (Fine and
    Wilf); else the gram at the end of that run, which breaks its period, must repeat at
    the lag, on either side. Grams are compared by hash, so lags may be too many, never too
    few.
    """
    n, most = len(ids), min(2 * size - 1, len(ids) // LEAST_PERIODS)
    grams = runs(ids.astype(np.uint64) + np.uint64(1), size)
    number = np.unique(grams, return_inverse=True)[1].astype(np.int64)
    order = np.sort(number * (n + 1) + np.arange(len(grams)))
    anchor = np.arange(0, len(grams), size)
    base = number[anchor] * (n + 1)
    low, high = (np.searchsorted(order, base + np.minimum(n, anchor + d), side) for d, side in ((size, "left"), (most, "right")))
    count = np.maximum(0, high - low)
    of = np.repeat(np.arange(len(anchor)), count)
    at = order[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())] % (n + 1)
    lag = at - anchor[of]
    stop = np.zeros(len(anchor), np.int64)  # of the known run that covers the gram
    for start, length, _ in known:
        if length >= size:
            inside = slice(-(-start // size), (start + length - size) // size + 1)
            stop[inside] = np.maximum(stop[inside], start + length)
    end = stop[of]
    free, broken = end == 0, end - size + 1

    def repeats(shift: np.ndarray) -> np.ndarray:
        ok = ~free & (broken >= 0) & (broken < len(grams)) & (broken + shift >= 0) & (broken + shift < len(grams))
        out = np.zeros(len(of), bool)
        out[ok] = number[broken[ok]] == number[(broken + shift)[ok]]
        return out

    keep = free | ((anchor[of] + size + lag > end) & (repeats(lag) | repeats(-lag)))
    return np.unique(lag[keep])


def word_runs(ids: np.ndarray, all_lags: int = ALL_LAGS) -> list[Run]:
    """All runs (start, length, period) of the sequence, by start, then period: stretches whose
    smallest period is ``period``, of at least LEAST_PERIODS periods and LEAST_WORDS words,
    that can't be longer at either end."""
    n = len(ids)
    last = n // LEAST_PERIODS
    if n < LEAST_WORDS or not last:
        return []
    rows, out = planes(ids), []
    by_period: dict[int, list[tuple[int, int]]] = {}

    def look(lags) -> None:
        new: list[tuple[int, int]] = []
        for q in lags:
            q = int(q)
            for start, length in at_lag(rows, n, q):
                # runs of one period overlap by less than it, so only the last that starts before can cover
                smaller = (by_period[d][bisect_right(by_period[d], (start, n)) - 1] for d in by_period if q % d == 0 and by_period[d][0][0] <= start)
                if not any(start + length <= end for _, end in smaller):
                    out.append((start, length, q))
                    new.append((start, start + length))
            if new:
                by_period[q] = new
                new = []

    if last <= all_lags:
        look(range(1, last + 1))
    else:
        size = 8
        look(range(1, min(size, last + 1)))
        while size <= last:
            look(lags_with_repeats(ids, size, out))
            size *= 2
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(n: int, found: list[Run]) -> np.ndarray:
    """Which of n words stay if of each run only the first period does."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of docs (doc_id of any type, text), a row for each.

    Words are what white space (space, \\t to \\r) parts. runs is an array of (start,
    length, period) by start, then period, start counted in words from 0. collapsed is the
    text's words, joined by a space, without those that a run has after its first period.
    A null or empty text has no words; repeated rows each give one. Texts are worked on
    whole, in the task that reads them: nothing is shuffled. The time grows with the
    words times the lags at which long grams repeat, divided by the bits of an integer.
    """
    kind = docs.schema["doc_id"].dataType
    own = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = strings(b.column("text"))
            for i, j in slices(texts):
                sizes, all_runs, left = [], [], []
                for text in texts[i:j].to_pylist():
                    said, number = _SPACED.findall(text), {}
                    ids = np.fromiter((number.setdefault(w, len(number)) for w in said), np.int64, len(said))
                    found = word_runs(ids)
                    if found:
                        said = [said[k] for k in np.flatnonzero(kept(len(said), found))]
                    sizes.append(len(ids))
                    all_runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    left.append(" ".join(said))
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[i:j].cast(own), pa.array(sizes, pa.int64()), pa.array(all_runs, pa.list_(_RUN)), pa.array(left, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_loops(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which a tenth of the documents, by the checksum of doc_id, repeat a
    stretch of their words from some word on to the end. A null doc_id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words, n = F.col("_w"), F.col("_n")
    t = docs.select("doc_id", "text", h.alias("_h"), g.alias("_g"))
    t = t.withColumn("_w", F.when(F.col("_h") % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))).withColumn("_n", F.size("_w"))
    a = (F.col("_g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("_g") % 8))).cast("int")
    t = t.withColumn("_a", F.when(n > 0, a)).withColumn("_p", F.when(n > 0, p))
    at = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    looped = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, at(i))), " ")
    return t.select("doc_id", F.when(n > 0, looped).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256,
    n_words) of find's rows; start to exponent_milli of the run with most periods, ties to
    the smallest start, then period. Quotients of lengths and periods are compared exactly."""
    better = lambda x, y: (x["length"] * y["period"] > y["length"] * x["period"]) | ((x["length"] * y["period"] == y["length"] * x["period"]) & (F.struct(x["start"], x["period"]) < F.struct(y["start"], y["period"])))
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda s, x: F.when(better(x, s), x).otherwise(s))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    text = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    t = found.withColumn("_best", best)
    milli = F.expr("(1000 * _best.length) div _best.period")
    return t.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period", milli.alias("exponent_milli"), F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
