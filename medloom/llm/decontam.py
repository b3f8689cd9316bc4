"""Benchmark decontamination by SimHash of item-sized windows and multi-index blocks."""

from __future__ import annotations

from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .shared import fresh, small, stage
from .words import runs, slices, strings, whole_runs, words

SHINGLE, LEAST, RADIUS = 5, 0.8, 15
#: Blocks of a fingerprint and their bits. Two fingerprints within RADIUS bits differ by at
#: most RADIUS // BLOCKS bits in a block at least.
BLOCKS, WIDTH = 4, 16
_NEAR = np.flatnonzero(np.bitwise_count(np.arange(1 << WIDTH, dtype=np.uint32)) <= RADIUS // BLOCKS)
#: Windows that look up their blocks at once, words that are fingerprinted at once, and pairs held at once.
WINDOWS, SPAN, PAIRS = 512, 1 << 14, 1 << 21
#: Bytes of different benchmark texts that are indexed and sent to the executors; a larger
#: benchmark meets the documents by joins.
PART_BYTES = 8 << 20
#: Bits at most, 32 MB, of the map that says which shingles a larger benchmark may have.
MOST_BITS = 1 << 28


def blocks(prints: np.ndarray) -> list[np.ndarray]:
    return [((prints >> np.uint64(WIDTH * j)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64) for j in range(BLOCKS)]


@dataclass
class Tables:
    """For each block, which fingerprints have a value in it: those of value v are
    order[start[v] : start[v + 1]]."""

    prints: np.ndarray
    start: list[np.ndarray]
    order: list[np.ndarray]

    @classmethod
    def of(cls, prints: np.ndarray) -> Tables:
        start, order = [], []
        for value in blocks(prints):
            order.append(np.argsort(value, kind="stable").astype(np.int32))
            start.append(np.append(0, np.cumsum(np.bincount(value, minlength=1 << WIDTH))).astype(np.int32))
        return cls(prints, start, order)

    def met(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number of a print asked for, number of a print held) of all pairs that come near in
        a block, which may come again in another one."""
        for value, start, order in zip(blocks(prints), self.start, self.order, strict=True):
            for i in range(0, len(prints), WINDOWS):
                ask = value[i : i + WINDOWS, None] ^ _NEAR[None, :]
                low, count = start[ask], start[ask + 1] - start[ask]
                row, column = np.nonzero(count)
                low, count = low[row, column], count[row, column].astype(np.int64)
                upto = np.cumsum(count)
                for x in range(0, int(upto[-1]) if len(upto) else 0, PAIRS):
                    at = np.arange(x, min(x + PAIRS, int(upto[-1])))
                    k = np.searchsorted(upto, at, side="right")
                    yield i + row[k], order[low[k] + at - (upto[k] - count[k])]

    def candidates(self, prints: np.ndarray, wanted: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of a print asked for, number of a print held, bits that differ) of all
        pairs within the radius, each once; only those held that are wanted."""
        pairs = []
        for w, i in self.met(prints):
            w, i = w[wanted[i]], i[wanted[i]]
            near = np.bitwise_count(prints[w] ^ self.prints[i]) <= radius
            pairs.append(np.unique(w[near] * len(self.prints) + i[near]))
        pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        w, i = pairs // max(1, len(self.prints)), pairs % max(1, len(self.prints))
        return w, i, np.bitwise_count(prints[w] ^ self.prints[i])


@dataclass
class Weights:
    """Weights of shingles: log(1 + items / items that hold it). A shingle of one item
    weighs as much as one of no item."""

    hashes: np.ndarray  #: sorted: the shingles of more than one item
    values: np.ndarray
    other: float

    @classmethod
    def of_counts(cls, hashes: np.ndarray, counts: np.ndarray, items: int) -> Weights:
        order = np.argsort(hashes)
        return cls(hashes[order], np.log1p(items / counts[order]), float(np.log1p(items)))

    def of(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(shingles), self.other)
        place = np.minimum(np.searchsorted(self.hashes, shingles), len(self.hashes) - 1)
        return np.where(self.hashes[place] == shingles, self.values[place], self.other)


@dataclass
class Index:
    ids: list
    shingles: list[Counter]
    sizes: np.ndarray  #: of the items, in words
    tables: Tables
    keys: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  #: by shingle length: sorted hashes, where their lists begin, sizes in words of their items
    bitmap: dict[int, np.ndarray]

    def similarity(self, window: Counter, item: int, weights: Weights) -> float:
        """Weighted Jaccard similarity of two bags of shingles."""
        own = self.shingles[item]
        of = {s: w for x in (own, window) for s, w in zip(x, weights.of(np.array(list(x), np.uint64)).tolist(), strict=True)}
        both = sum(min(n, window.get(s, 0)) * of[s] for s, n in own.items())
        total = sum(n * of[s] for s, n in own.items()) + sum(n * of[s] for s, n in window.items())
        return both / (total - both) if total > both else 1.0


def _prints(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """SimHash of shingles begin:end, from running sums of their signed, weighted bits."""
    return ((sums[end] - sums[begin] > 1e-9) * (np.uint64(1) << np.arange(64, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)


def _running(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(hashes) + 1, 64))
    np.cumsum((2.0 * bits - 1) * weights[:, None], axis=0, out=out[1:])
    return out


def _shingles(texts: pa.Array) -> list[np.ndarray]:
    w = words(texts, lower=True)
    h = w.hashes()
    lists = [h[a:b] for a, b in zip(w.first, w.first[1:], strict=False)]
    return [runs(x, min(SHINGLE, len(x))) if len(x) else x for x in lists]


def count(items: list[tuple]) -> Weights:
    """The weights of the shingles of items (times, text)."""
    held: Counter = Counter()
    total = 0
    for (n, _), x in zip(items, _shingles(pa.array([t or "" for _, t in items], pa.string())), strict=True):
        total += n if len(x) else 0
        for s in set(x.tolist()):
            held[s] += n
    held = {s: n for s, n in held.items() if n > 1}
    return Weights.of_counts(np.array(list(held), np.uint64), np.array(list(held.values()), np.int64), total)


def index(items: list[tuple], weights: Weights | None = None) -> Index:
    """Of (item_id, text); items without words are left out. The weights are those of the
    whole benchmark; without them, the items are taken to be all of it."""
    weights = weights or count([(1, t) for _, t in items])
    texts = pa.array([t or "" for _, t in items], pa.string())
    counts = words(texts).counts().tolist()
    ids, lists, sizes = [], [], []
    for (name, _), n, x in zip(items, counts, _shingles(texts), strict=True):
        if n:
            ids.append(name)
            sizes.append(n)
            lists.append(x)
    prints = np.array([_prints(_running(x, weights.of(x)), np.array([0]), np.array([len(x)]))[0] for x in lists], np.uint64)
    keys, bitmap = {}, {}
    for k in sorted({min(SHINGLE, n) for n in sizes}):
        pairs = sorted({(s, n) for x, n in zip(lists, sizes, strict=True) if min(SHINGLE, n) == k for s in x.tolist()})
        hashes = np.array([s for s, _ in pairs], np.uint64)
        unique, start = np.unique(hashes, return_index=True)
        keys[k] = (unique, np.append(start, len(pairs)), np.array([n for _, n in pairs]))
        bitmap[k] = np.zeros(1 << 20, bool)
        bitmap[k][(unique & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    return Index(ids, [Counter(x.tolist()) for x in lists], np.array(sizes, np.int64), Tables.of(prints), keys, bitmap)


def _free(taken: list[int], at: int, size: int) -> int | None:
    """Where a window at ``at`` stands among those taken, which are sorted; None if it
    overlaps one."""
    i = bisect(taken, at)
    return None if i and at - taken[i - 1] < size or i < len(taken) and taken[i] - at < size else i


def search(ix: Index, weights: Weights, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int, float]]:
    """(text, item, first word, end, bits, similarity) of windows that are as long as an
    item and similar to it; of windows of an item that overlap, the nearest.

    A window similar to an item shares a shingle with an item of its size, so only such
    windows get a fingerprint. The blocks say which items' fingerprints may be within
    RADIUS bits of it, and those that are get compared shingle by shingle.
    """
    for i, j in slices(texts):
        w = words(texts[i:j], lower=True)
        h, owner = w.hashes(), w.owner()
        spots: dict[tuple[int, int], list[int]] = {}
        grams = {}
        for k, (unique, start, sizes) in ix.keys.items():
            g = grams[k] = runs(h, k)
            at = np.flatnonzero(ix.bitmap[k][(g & np.uint64((1 << 20) - 1)).astype(np.int64)] & whole_runs(w.first, k)) if len(g) else np.zeros(0, np.int64)
            place = np.searchsorted(unique, g[at])
            hit = np.flatnonzero(unique[np.minimum(place, len(unique) - 1)] == g[at])
            for p, q in zip(at[hit].tolist(), place[hit].tolist(), strict=True):
                for n in sizes[start[q] : start[q + 1]].tolist():
                    spots.setdefault((int(owner[p]), n), []).append(p)
        for (text, n), at in spots.items():
            k = min(SHINGLE, n)
            low, high = int(w.first[text]), int(w.first[text + 1]) - n
            if high < low:
                continue
            edge = np.zeros(high - low + 2, np.int64)
            p = np.array(at) - low
            np.add.at(edge, np.clip(p - (n - k), 0, high - low + 1), 1)
            np.add.at(edge, np.clip(p + 1, 0, high - low + 1), -1)
            begin = np.flatnonzero(np.cumsum(edge[:-1]) > 0) + low
            found = []
            for a, b in pairwise([0, *(np.flatnonzero(np.diff(begin // SPAN)) + 1).tolist(), len(begin)]):
                some = begin[a:b]
                if len(some):
                    first = int(some[0])
                    own = grams[k][first : int(some[-1]) + n - k + 1]
                    win, item, bits = ix.tables.candidates(_prints(_running(own, weights.of(own)), some - first, some - first + n - k + 1), ix.sizes == n)
                    found.append((some[win], item, bits))
            taken: dict[int, list[int]] = {}
            win, item, bits = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 3
            for x in np.lexsort((win, bits)).tolist():
                a, name = int(win[x]), int(item[x])
                near = taken.setdefault(name, [])
                if (spot := _free(near, a, n)) is None:
                    continue
                s = ix.similarity(Counter(grams[k][a : a + n - k + 1].tolist()), name, weights)
                if s >= LEAST:
                    near.insert(spot, a)
                    yield i + text, name, a - low, a - low + n, int(bits[x]), s


def _counted(texts: DataFrame) -> Weights:
    """The weights of the shingles of texts (text, n), counted where the rows are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, times = strings(b.column("text")), b.column("n").to_numpy()
            for i, j in slices(texts):
                lists = [np.unique(x) for x in _shingles(texts[i:j])]
                sizes = [len(x) for x in lists]
                s = np.concatenate(lists).astype(np.uint64)
                # the row without a shingle counts items
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(np.repeat(times[i:j], sizes))], ["s", "n"])
                yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([int(times[i:j][np.array(sizes) > 0].sum())], pa.int64())], ["s", "n"])

    held = texts.select("text", "n").mapInArrow(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).where("n > 1 or s is null").toArrow()
    s, n = held.column("s"), held.column("n").to_numpy()
    items = s.is_null().to_numpy()
    return Weights.of_counts(s.fill_null(0).to_numpy()[~items].astype(np.int64).view(np.uint64), n[~items], int(n[items].sum()))


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def _different(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """(name, text, n) of the different texts, named by their MD5, and their bytes."""
    texts = stage(benchmark.select(_text().alias("text")).groupBy("text").agg(F.count("*").alias("n")).withColumn("name", F.md5("text")), "benchmark")
    return texts, texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


_FOUND = "name string, first_word long, end_word long, bits long, similarity double"
_NAMES = ["name", "first_word", "end_word", "bits", "similarity"]


def _columns(ix: Index, rows: list[tuple]) -> list[pa.Array]:
    """What search found, without the texts' numbers."""
    c = list(zip(*rows, strict=True)) or [()] * 6
    return [pa.array([ix.ids[x] for x in c[1]], pa.string()), *(pa.array(x, pa.int64()) for x in c[2:5]), pa.array(c[5], pa.float64())]


def _sent(texts: DataFrame) -> tuple:
    """The index and the weights of a small benchmark, sent along with the tasks."""
    sc = texts.sparkSession.sparkContext
    weights = _counted(texts)
    ix = index([(r.name, r.text) for r in texts.select("name", "text").orderBy("name").collect()], weights)  # PART_BYTES at most
    return sc.broadcast(ix), sc.broadcast(weights)


def _item_shingles(texts: DataFrame) -> DataFrame:
    """(name, k, s, c): each item's different shingles, of k words, and how often it has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, names = strings(b.column("text")), b.column("name")
            for i, j in slices(own):
                sizes = words(own[i:j]).counts()
                pairs = [np.unique(x, return_counts=True) for x in _shingles(own[i:j])]
                n = np.array([len(x) for x, _ in pairs])
                s, c = (np.concatenate([p[q] for p in pairs]) for q in (0, 1))
                yield pa.RecordBatch.from_arrays([names[i:j].take(pa.array(np.repeat(np.arange(j - i), n))), pa.array(np.repeat(np.minimum(SHINGLE, sizes), n).astype(np.int32)), pa.array(s.astype(np.uint64).view(np.int64)), pa.array(c.astype(np.int64))], ["name", "k", "s", "c"])

    return texts.select("name", "text").mapInArrow(run, "name string, k int, s long, c long")


def _bitmap(held: DataFrame) -> np.ndarray:
    """Bits that are set at the last places of the shingles s of held, 16 bits for each
    shingle up to MOST_BITS. Tasks make pieces of it."""
    bits = min(MOST_BITS, max(1 << 20, 1 << int(16 * held.count()).bit_length()))
    piece = 1 << 16

    def run(key: tuple, t: pa.Table) -> pa.Table:
        out = np.zeros(piece, np.uint8)
        out[t.column("at").to_numpy()] = 1
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int64()), "raw": pa.array([np.packbits(out).tobytes()], pa.binary())})

    at = held.select(F.col("s").bitwiseAND(F.lit(bits - 1)).alias("place")).distinct().select(F.shiftright("place", 16).alias("piece"), F.col("place").bitwiseAND(F.lit(piece - 1)).cast("int").alias("at"))
    out = np.zeros(bits // 8, np.uint8)
    for r in at.groupBy("piece").applyInArrow(run, "piece long, raw binary").toLocalIterator():
        out[r.piece * piece // 8 : (r.piece + 1) * piece // 8] = np.frombuffer(r.raw, np.uint8)
    return out


def _hits(docs: DataFrame, lengths: list[int], bitmap) -> DataFrame:
    """(t, s): the different shingles of each text of docs (t, text) that the bitmap holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        last = np.uint64(8 * len(bits) - 1)
        for b in batches:
            texts, t = strings(b.column("text")), b.column("t")
            for i, j in slices(texts):
                w = words(texts[i:j], lower=True)
                h, owner = w.hashes(), w.owner()
                for k in lengths:
                    g = runs(h, k)
                    low = g & last
                    at = np.flatnonzero(((bits[(low >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (low & np.uint64(7))).astype(np.uint8)) & 1).astype(bool) & whole_runs(w.first, k)) if len(g) else np.zeros(0, np.int64)
                    pairs = np.unique(np.stack([owner[at].astype(np.uint64), g[at]], axis=1), axis=0) if len(at) else np.zeros((0, 2), np.uint64)
                    yield pa.RecordBatch.from_arrays([t[i:j].take(pa.array(pairs[:, 0].astype(np.int64))), pa.array(np.ascontiguousarray(pairs[:, 1]).view(np.int64))], ["t", "s"])

    return docs.mapInArrow(run, "t string, s long")


def _met(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(t, name, first_word, end_word, bits, similarity): what search finds in the texts of docs
    (t, text), t being a text's MD5, for a benchmark of any size.

    Shingles bring documents and items together. A window of similarity LEAST shares LEAST
    of an item's weight, so it shares one of any shingles of the item that weigh more than
    the rest of it; of each item those are taken that the fewest texts have. Only texts and
    items that share one of these meet. A text is then searched for its own items, with the
    weights of the whole benchmark.
    """
    sc = docs.sparkSession.sparkContext
    own = stage(_item_shingles(texts), "shingles")
    total = own.select("name").distinct().join(texts.select("name", "n"), "name").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counted = stage(own.join(texts.select("name", "n"), "name").groupBy("s").agg(F.sum("n").alias("n")), "counts")
    lengths = sorted(r.k for r in own.select("k").distinct().collect())  # SHINGLE at most
    hits = stage(_hits(docs, lengths, sc.broadcast(_bitmap(counted))).join(counted.select("s"), "s", "left_semi"), "hits")
    seen = hits.groupBy("s").agg(F.count("*").alias("texts"))
    heavy = own.join(counted, "s").withColumn("weight", F.col("c") * F.log1p(F.lit(float(total)) / F.col("n"))).join(seen, "s", "left")
    w = W.partitionBy("name").orderBy(F.coalesce("texts", F.lit(0)), "s")
    before = F.coalesce(F.sum("weight").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rare = heavy.withColumn("before", before).withColumn("all", F.sum("weight").over(W.partitionBy("name")))
    rare = rare.where((F.col("before") <= (1 - LEAST) * (1 + 1e-9) * F.col("all")) & F.col("texts").isNotNull()).select("name", "s")
    pairs = stage(rare.join(hits, "s").select("t", "name").distinct(), "pairs")
    shared = counted.where("n > 1")
    common = lambda rows, key: rows.join(shared, "s").groupBy(key).agg(F.collect_set(F.struct("s", "n")).alias("common"))
    wanted = small(stage(pairs.select("t").distinct(), "wanted"), 64)
    asked = docs.join(wanted, "t", "left_semi").groupBy("t").agg(F.first("text").alias("text")).join(common(hits.join(wanted, "t", "left_semi"), "t"), "t", "left")
    items = pairs.join(texts.select("name", "text"), "name").join(common(own, "name"), "name", "left")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = {x["s"]: x["n"] for t in (left, right) for row in t.column("common").to_pylist() for x in row or ()}
        weights = Weights.of_counts(np.array(list(known), np.int64).view(np.uint64), np.array(list(known.values()), np.int64), total)
        rows, ix = [], index(list(zip(right.column("name").to_pylist(), right.column("text").to_pylist(), strict=True)), weights)
        if left.num_rows and len(ix.ids):
            rows = list(search(ix, weights, strings(left.column("text"))))
        return pa.table([left.column("t").combine_chunks().take(pa.array([x[0] for x in rows], pa.int64())), *_columns(ix, rows)], ["t", *_NAMES])

    return asked.groupBy("t").cogroup(items.groupBy("t")).applyInArrow(run, f"t string, {_FOUND}")


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per benchmark passage in a document: (doc_id, item_id, first_word, end_word,
    bits, similarity), similarity the weighted Jaccard similarity, at least 0.8, of the
    5-word shingles of the window and the item.

    Words are those between ASCII white space, A-Z in lower case. A benchmark of at most
    PART_BYTES is indexed and sent along with the tasks, which read the documents once and
    don't shuffle them. A larger one meets the documents by joins on shingles, with the
    same result; texts are read twice then, whatever its size, and those shuffled that
    share a rare shingle with an item. Weights count the items of the whole benchmark. An
    item of fewer than 5 words is one shingle; items and documents without words (null
    texts too) match nothing. Repeated rows give repeated matches, and equal items each
    match: a match names the item's text, and is then joined with the rows that have it.
    """
    texts, size = _different(benchmark)
    if size <= PART_BYTES:
        kind = docs.schema["doc_id"].dataType.simpleString()
        shared, weights = _sent(texts)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = list(search(shared.value, weights.value, strings(b.column("text"))))
                own = b.column("doc_id").take(pa.array([x[0] for x in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays([own, *_columns(shared.value, rows)], ["doc_id", *_NAMES])

        out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_FOUND}")
    else:
        named = docs.select("doc_id", _text().alias("text"), F.md5(_text()).alias("t"))
        found = small(stage(_met(named.select("t", "text"), texts), "found"), 128)
        out = named.select("doc_id", "t").join(found, "t").drop("t")
    return out.join(benchmark.select("item_id", F.md5(_text()).alias("name")), "name").select("doc_id", "item_id", *_NAMES[1:])


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs whose text holds no benchmark passage, with their columns."""
    texts, size = _different(benchmark)
    if size > PART_BYTES:
        named = docs.withColumn(t := fresh(docs, "t"), F.md5(_text()))
        found = _met(named.select(F.col(t).alias("t"), _text().alias("text")), texts).select(F.col("t").alias(t)).distinct()
        return named.join(small(stage(found, "found"), 64), t, "left_anti").select(docs.columns)
    shared, weights = _sent(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            clean = np.ones(b.num_rows, bool)
            clean[[x[0] for x in search(shared.value, weights.value, strings(b.column("text")))]] = False
            yield b.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
