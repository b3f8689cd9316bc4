"""SimHash near-duplicates by vantage-point trees over the fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import fresh, row_hash, small, stage
from .words import mix, slices, strings

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Shingles whose hashes are held at once.
HASHES = 1 << 18
#: Blocks of a fingerprint's bits in two groups. Two blocks of a group make a part, and each of
#: the six parts has a tree of its own that shards the fingerprints.
GROUPS = ((11, 11, 10), (11, 11, 10))
PARTS = 6
#: Fingerprints sampled to build these trees, and fingerprints aimed at in a shard.
SAMPLE, SHARD = 65_536, 8_192
#: Points of a leaf that are compared with all queries that reach it, and pairs compared at once.
LEAF, BLOCK = 256, 1 << 21
#: Fingerprints of one role that a task compares; those of one value of a part, where they are
#: more, are cut into tiles.
TILE = 60_000


def _ones(hashes: list[int], starts: np.ndarray) -> np.ndarray:
    """How many of the hashes from each start to the next have each bit set."""
    bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def _fingerprints(texts: pa.Array, shingle: int, seed: int) -> np.ndarray:
    """Bit i of a text's fingerprint is 1 if set in over half of its shingles' hashes. The
    hashes of at most some HASHES shingles are held at once."""
    sizes, ones = np.zeros(len(texts), np.int64), np.zeros((len(texts), 64), np.int64)
    digest, weights = xxhash.xxh64_intdigest, np.uint64(1) << np.arange(64, dtype=np.uint64)
    for begin, end in slices(texts):
        hashes, starts, of = [], [], []

        def count(hashes=hashes, starts=starts, of=of) -> None:
            if of:
                np.add.at(ones, of, _ones(hashes, np.array(starts)))
            for held in (hashes, starts, of):
                held.clear()

        for i, text in enumerate(texts[begin:end].to_pylist(), begin):
            words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
            n, sizes[i] = len(words), max(1, len(words) - shingle + 1) if words else 0
            if not n:
                continue
            line = b" ".join(words)
            stops = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
            del words
            for at in range(0, int(sizes[i]), HASHES):
                m = min(HASHES, int(sizes[i]) - at)
                starts.append(len(hashes))
                of.append(i)
                a = [0, *(stops[: m - 1] + 1).tolist()] if not at else (stops[at - 1 : at - 1 + m] + 1).tolist()
                b = stops[at + min(shingle, n) - 1 :][:m].tolist()
                hashes += [digest(line[x:y], seed) for x, y in zip(a, b, strict=True)]
                if len(hashes) >= HASHES:
                    count()
        count()
    return ((2 * ones > sizes[:, None]) * weights).sum(axis=1, dtype=np.uint64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, *also: str) -> DataFrame:
    """(doc_id, also, fp): the SimHash of each document, as a signed long.

    Words are those between ASCII white space, A-Z in lower case; shingles are
    ``shingle`` words joined by a space, repeats counted; fewer words make one shingle,
    none (or a null text) the fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = _fingerprints(strings(b.column("text")), shingle, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(fp)], [*kept, "fp"])

    kept = ["doc_id", *also]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.select(*kept, "text").mapInArrow(run, f"{kinds}, fp long")


def _far(points: np.ndarray, x: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ x).astype(np.int16)


def _split(points: np.ndarray, turn: int) -> tuple[np.uint64, int, np.ndarray] | None:
    """A vantage point, the radius that halves the points, and their distances. Of a few
    points and their complements' kin, the one whose distances are most spread. None if
    all stand at the same distance from each."""
    best = None
    for x in points[mix(np.arange(turn, turn + 5, dtype=np.uint64)) % np.uint64(len(points))]:
        d = _far(points, x)
        r = int(np.median(d))
        if (d > r).any() and (d <= r).any() and (best is None or d.std() > best[3]):
            best = (x, r, d, d.std())
    return best[:3] if best else None


def build(sample: np.ndarray, depth: int, at: int = 1) -> dict[int, tuple[int, int]]:
    """The top of the tree: {node: (vantage point, radius)}; node n has children 2n, 2n+1."""
    if not depth or len(sample) < 8 or not (s := _split(sample, at)):
        return {}
    x, r, d = s
    return {at: (int(x), r)} | build(sample[d <= r], depth - 1, 2 * at) | build(sample[d > r], depth - 1, 2 * at + 1)


def route(tree: dict[int, tuple[int, int]], points: np.ndarray, radius: int, at: int = 1, own: np.ndarray | None = None, home: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The leaf in which each point lives, and further leaves that hold points within the
    radius: (leaf, numbers of points, whether they live there). By the triangle inequality
    a point within radius of x lies at a distance from the vantage point that differs by at
    most radius. Of two near points in different halves only the inner one crosses over,
    so a pair meets once.
    """
    if own is None:
        own, home = np.arange(len(points)), np.ones(len(points), bool)
    if at not in tree or not len(own):
        if len(own):
            yield at, own, home
        return
    x, r = tree[at]
    d = _far(points[own], np.uint64(x))
    inner = np.where(home, d <= r, d <= r + radius)
    yield from route(tree, points, radius, 2 * at, own[inner], home[inner])
    outer = d > r - radius
    yield from route(tree, points, radius, 2 * at + 1, own[outer], home[outer] & (d[outer] > r))


def parts(points: np.ndarray) -> list[np.ndarray]:
    """The six parts of each point's bits, as points of their own."""
    out, low = [], 0
    for group in GROUPS:
        blocks = []
        for width in group:
            blocks.append((points >> np.uint64(low)) & np.uint64((1 << width) - 1))
            low += width
        out += [(blocks[i] << np.uint64(group[j])) | blocks[j] for i, j in ((0, 1), (0, 2), (1, 2))]
    return out


def part_radius(radius: int) -> int:
    """Points within radius bits differ by at most so many in one of the parts: one group has
    half of the bits at most, and the block with most of these is in one of its three
    parts only by two others."""
    return 2 * (radius // 2) // 3


class Links:
    """A spanning forest of the links seen so far: no more edges than points, whatever
    the number of pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.label[a], self.label[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if not len(a):
                return
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while (self.label != (up := self.label[self.label])).any():
                self.label = up


def near(points: np.ndarray, living: np.ndarray, asking: np.ndarray, radius: int, links: Links, turn: int = 1) -> None:
    """Link all pairs within radius of a living point and another living or an asking one
    (numbers into points), by a tree over the living."""
    if not len(living) or len(living) + len(asking) < 2:
        return
    s = _split(points[living], turn) if len(living) > LEAF else None
    if s is None:
        all_of = np.concatenate([living, asking])
        step = max(1, BLOCK // len(all_of))
        for i in range(0, len(living), step):
            part = living[i : i + step]
            a, b = np.nonzero(np.bitwise_count(points[part][:, None] ^ points[all_of][None, :]) <= radius)
            links.add(part[a], all_of[b])
        return
    x, r, d = s
    q = _far(points[asking], x)
    cross = living[(d <= r) & (d > r - radius)]
    near(points, living[d <= r], asking[q <= r + radius], radius, links, 2 * turn)
    near(points, living[d > r], np.concatenate([cross, asking[q > r - radius]]), radius, links, 2 * turn + 1)


def placed(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(leaf, sub, i, j, fp, home): where each of fps (fp) is compared, as links says."""
    total = fps.count()
    depth = max(0, int(np.ceil(np.log2(max(1, total) / SHARD))))
    trees: list[dict[int, tuple[int, int]]] = [{}]
    if depth:
        rows = fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
        trees = [build(x, depth) for x in parts(np.array([r.fp for r in rows], np.int64).view(np.uint64))]
    ball = part_radius(radius)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for i, (tree, x) in enumerate(zip(trees, parts(p), strict=False)):
                for leaf, own, home in route(tree, x, ball):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), leaf * PARTS + i, np.int64)), pa.array(x[own].view(np.int64)), pa.array(p[own].view(np.int64)), pa.array(home)], ["leaf", "value", "fp", "home"])

    none = F.lit(0)
    if not depth:
        return fps.select(none.cast("long").alias("leaf"), none.alias("sub"), none.alias("i"), none.alias("j"), "fp", F.lit(True).alias("home"))
    rows = stage(fps.mapInArrow(spread, "leaf long, value long, fp long, home boolean"), "placed")
    if ball:
        rows = rows.withColumn("sub", none)
    else:  # near points have the same value in a part, so a leaf may be dealt by it
        many = rows.groupBy("leaf").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("subs"))
        rows = rows.join(F.broadcast(many), "leaf")  # a row a leaf: fewer than PARTS * SAMPLE / 4
        rows = rows.withColumn("sub", F.pmod(F.xxhash64("value"), "subs").cast("int"))
    if total <= TILE:
        return rows.select("leaf", "sub", none.alias("i"), none.alias("j"), "fp", "home")
    sizes = rows.groupBy("leaf", "sub").agg(F.ceil(F.sum(F.col("home").cast("int")) / TILE).cast("int").alias("rows"), F.ceil(F.count("*") / TILE).cast("int").alias("cols"))
    sizes = small(stage(sizes.where("rows > 1 or cols > 1"), "sizes"), 32)
    rows = rows.join(sizes, ["leaf", "sub"], "left").withColumns({"rows": F.coalesce("rows", F.lit(1)), "cols": F.coalesce("cols", F.lit(1))})
    own = F.xxhash64("fp")
    as_home = F.when(F.col("home"), F.transform(F.sequence(none, F.col("cols") - 1), lambda j: F.struct(F.pmod(own, "rows").cast("int").alias("i"), j.alias("j"), F.lit(True).alias("lives")))).otherwise(F.array())
    as_query = F.transform(F.sequence(none, F.col("rows") - 1), lambda i: F.struct(i.alias("i"), F.pmod(own, "cols").cast("int").alias("j"), F.lit(False).alias("lives")))
    whole = F.array(F.struct(none.alias("i"), none.alias("j"), F.col("home").alias("lives")))
    tiles = F.when((F.col("rows") == 1) & (F.col("cols") == 1), whole).otherwise(F.concat(as_home, as_query))
    return rows.select("leaf", "sub", "fp", F.explode(tiles).alias("x")).select("leaf", "sub", "x.i", "x.j", "fp", F.col("x.lives").alias("home"))


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (src, dst) that connect what the links within ``radius`` bits connect.

    fps: (fp), distinct. Points within ``radius`` bits differ by at most part_radius in one
    of the six parts of their bits: not at all for the radius 3. A bounded sample (SAMPLE
    fingerprints, lowest hash first) gives, for each part, the top of a vantage-point tree of
    about SHARD fingerprints a leaf; every fingerprint goes to its leaf in each tree, and to
    those that its ball of that smaller radius overlaps. Where the tree ends, be it that the
    sample is used up or that points stand at equal distances, a leaf of more than SHARD is
    dealt on by the hash of the part's value, which near points share; so a fingerprint has
    six places however many there are. (A ball of radius 3 in all 64 bits overlaps most
    leaves: one tree gave each fingerprint 37 places at depth 10, half as many again at each
    further level.) Only a value of a part that more than TILE fingerprints have is cut into
    tiles of living by asking points. Each task finds its pairs within ``radius`` exactly, by
    a tree of its own over all bits, and returns a star for each group of linked points,
    never the pairs.
    """

    def pairs(key: tuple, t: pa.Table) -> pa.Table:
        p = t.column("fp").to_numpy().view(np.uint64)
        home = t.column("home").to_numpy()
        found = Links(len(p))
        near(p, np.flatnonzero(home), np.flatnonzero(~home), radius, found)
        moved = np.flatnonzero(found.label != np.arange(len(p)))
        return pa.table({"src": p.view(np.int64)[moved], "dst": p.view(np.int64)[found.label[moved]]})

    return placed(fps, radius).groupBy("leaf", "sub", "i", "j").applyInArrow(pairs, "src long, dst long").where("src <> dst")


def _classed(rows: DataFrame, least: Column, radius: int) -> DataFrame:
    """(fp, best): of each fingerprint of rows (fp, ...), the smallest ``least`` of its class.
    Equal fingerprints are one point, so copies cost a partial minimum only."""
    points = stage(rows.groupBy("fp").agg(F.min(least).alias("least")), "points")
    label = components(links(points.select("fp"), radius))
    named = points.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    best = named.groupBy("label").agg(F.min("least").alias("best"))
    return stage(named.join(best, "label").select("fp", "best"), "classes")


def classes(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, radius: int = RADIUS) -> DataFrame:
    """One row per document: (doc_id, fp, component_id).

    Documents whose fingerprints differ in at most ``radius`` bits are linked, and
    component_id is the smallest doc_id that links reach, itself included. Documents without
    words share the fingerprint 0 and are linked like any other. A null doc_id counts as
    larger than any other; a class that has no other gets null. Repeated rows stay. The
    classes come back by a join on the fingerprint, of which Spark splits a hot one.
    """
    fp = stage(fingerprints(docs, shingle, seed), "fingerprints")
    named = _classed(fp, F.col("doc_id"), radius).withColumnRenamed("best", "component_id")
    return fp.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, radius: int = RADIUS) -> DataFrame:
    """One row of each class stays, with its columns: that with the smallest doc_id, a null
    one being larger than any other; of several such rows that with the smallest hash of
    all columns.

    Rows are judged by their own text, not by that of another row of their doc_id. Up to
    8 MB of decisions (doc_id and hash) are broadcast and texts stay where they are; beyond,
    they are shuffled once. Only rows that are equal in all columns are shuffled besides.
    """
    marked = docs.withColumn(name := fresh(docs, "hash"), row_hash(docs))
    rows = stage(fingerprints(marked.select("doc_id", "text", F.col(name).alias("hash")), shingle, seed, "hash"), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    best = _classed(rows, order, radius).select("best.doc_id", "best.hash").distinct()
    mine = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["hash"] == b["hash"])
    kept = stage(rows.join(best, mine(rows, best)).groupBy(best["doc_id"], best["hash"]).agg(F.count("*").alias("n")), "kept")

    def only(some: DataFrame) -> DataFrame:
        some = small(stage(some, "some"), 32)
        return marked.join(some, marked["doc_id"].eqNullSafe(some["doc_id"]) & (marked[name] == some["hash"]), "left_semi")

    once, again = kept.where("n = 1"), kept.where("n > 1")
    out = only(once)
    if not again.isEmpty():
        out = out.unionByName(only(again).dropDuplicates(["doc_id", name]))
    return out.select(docs.columns)
