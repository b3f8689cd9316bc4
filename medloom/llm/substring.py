"""Passages that stand in an earlier document, by suffix automata of reference shards."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .shared import small, stage
from .words import Words, _table, mix, runs, signed, slices, strings, whole_runs, words

#: Words of a window, and of the runs whose least hash names a window's shard.
WINDOW, ANCHOR = 50, 8
#: Words of segments that are trimmed at once.
CHUNK = 400_000
#: A segment with at least 1/HOT of all rows is joined by broadcast: HOT rows at most.
HOT = 1_000
#: Segments of a shard that a task holds; those of a larger one are trimmed and merged before.
SHARD = 4_096
_SIDE = "m long, c long, doc_id {kind}, tag int, pos int, at int, side int"


class Automaton:
    """Suffix automaton of sequences of hashable tokens, built as they come."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.last = [-1], [0], 0

    def extend(self, token) -> None:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append({})
        length.append(length[self.last] + 1)
        link.append(0)
        p = self.last
        while p >= 0 and token not in nxt[p]:
            nxt[p][token] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][token]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(token) == q:
                    nxt[p][token] = clone
                    p = link[p]
                link[q] = link[new] = clone
        self.last = new

    def add(self, tokens: Iterable) -> None:
        for t in tokens:
            self.extend(t)
        self.extend(object())  # nothing matches across the end

    def ends(self, tokens: Iterable, least: int) -> Iterator[int]:
        """Where matches of at least ``least`` tokens end: the matching statistic at i is the
        longest match that ends there."""
        state = size = 0
        nxt, link, length = self.next, self.link, self.length
        for i, t in enumerate(tokens, 1):
            while t not in nxt[state] and state:
                state = link[state]
                size = length[state]
            if t in nxt[state]:
                state, size = nxt[state][t], size + 1
            if size >= least:
                yield i

    def spans(self, tokens: Iterable, least: int) -> list[tuple[int, int]]:
        """Maximal spans of tokens that are covered by matches of at least ``least``."""
        return merged(self.ends(tokens, least), least)


def merged(ends: Iterable[int], size: int) -> list[tuple[int, int]]:
    """Maximal spans of the words of windows of ``size`` words with these ends, which rise."""
    out: list[list[int]] = []
    for i in ends:
        if out and i - size <= out[-1][1]:
            out[-1][1] = i
        else:
            out.append([i - size, i])
    return [(a, b) for a, b in out]


def _ranges(h: np.ndarray) -> np.ndarray:
    up, _ = _table(len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=sums[1:])
    return sums


def _range_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the words begin:end, wherever they stand."""
    _, down = _table(len(sums))
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def _segments(w: Words, window: int, anchor: int) -> dict[str, np.ndarray]:
    """Runs of windows that share their least anchor: its hash m, a hash c of the run's
    words, the text, the place of its first word and its length in words. The least
    anchor (the leftmost of equals) depends on a window's words alone, so equal windows
    are in segments with equal m."""
    h = w.hashes()
    inside = whole_runs(w.first, window)
    at = np.flatnonzero(inside)
    if not len(at):
        return {k: np.zeros(0, np.int64) for k in ("m", "c", "text", "pos", "n")}
    g = runs(h, anchor)
    least, spot = g, np.arange(len(g))
    need, have = window - anchor + 1, 1
    while have < need:
        step = min(have, need - have)
        later = least[step:] < least[:-step]
        least, spot = np.where(later, least[step:], least[:-step]), np.where(later, spot[step:], spot[:-step])
        have += step
    place = spot[at]
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(new)
    begin = at[head]
    end = at[np.append(head[1:], len(at)) - 1] + window
    text = w.owner()[begin]
    return {"m": signed(g[place[head]]), "c": signed(_range_hash(_ranges(h), begin, end)), "text": text, "pos": begin - w.first[text], "n": end - begin}


def segments(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(m, c, doc_id, tag, pos, n) of all texts; docs: (doc_id, tag, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = strings(b.column("text"))
            for i, j in slices(texts):
                s = _segments(words(texts[i:j]), window, anchor)
                pick = pa.array(s["text"] + i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s["m"]), pa.array(s["c"]), b.column("doc_id").take(pick), b.column("tag").take(pick), pa.array(s["pos"].astype(np.int32)), pa.array(s["n"].astype(np.int32))],
                    ["m", "c", "doc_id", "tag", "pos", "n"],
                )

    return docs.where("doc_id is not null").mapInArrow(run, f"m long, c long, doc_id {_kind(docs)}, tag int, pos int, n int")


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of documents with lists of segments, the segments with their words."""
    for b in batches:
        rows: dict[str, list] = {"m": [], "c": [], "words": []}
        pick = []
        for i, (text, wanted) in enumerate(zip(b.column("text").to_pylist(), b.column("wanted").to_pylist(), strict=True)):
            if wanted:
                parts = (text or "").encode().split()
                for x in wanted:
                    pick.append(i)
                    rows["m"].append(x["m"])
                    rows["c"].append(x["c"])
                    rows["words"].append(b" ".join(parts[x["pos"] : x["pos"] + x["n"]]).decode())
        doc = b.column("doc_id").take(pa.array(pick, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(rows["m"], pa.int64()), pa.array(rows["c"], pa.int64()), doc, pa.array(rows["words"], pa.string())], ["m", "c", "doc_id", "words"])


def _windows(window: int):
    """Of documents with lists of segments, the hashes of each segment's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lists = strings(b.column("text")), b.column("wanted").to_pylist()
            for i, j in slices(texts):
                w = words(texts[i:j])
                g = signed(runs(w.hashes(), window))
                rows = [(x["m"], x["c"], k, w.first[k - i] + x["pos"], x["n"] - window + 1) for k in range(i, j) for x in lists[k]]
                m, c, pick, at, n = zip(*rows, strict=True) if rows else [()] * 5
                ends = np.append(0, np.cumsum(n)).astype(np.int32)
                held = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([g[a : a + k] for a, k in zip(at, n, strict=True)]) if rows else g[:0]))
                yield pa.RecordBatch.from_arrays([pa.array(m, pa.int64()), pa.array(c, pa.int64()), b.column("doc_id").take(pa.array(pick, pa.int64())), held], ["m", "c", "doc_id", "windows"])

    return run


def _chain(sums: np.ndarray, begin: np.ndarray, end: np.ndarray, m: np.ndarray, left: np.ndarray) -> np.ndarray:
    """A hash of what reaches from a shard's anchor m to a word on its left or right."""
    return mix(_range_hash(sums, begin, end) + mix(m) + left.astype(np.uint64))


def _sides(window: int, anchor: int):
    """Of documents with lists of segments, two rows a segment: the hashes of what reaches
    from its anchor to each word on the left (side 0) and on the right (side 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lists = strings(b.column("text")), b.column("wanted").to_pylist()
            for i, j in slices(texts):
                w = words(texts[i:j])
                h = w.hashes()
                g, sums = signed(runs(h, anchor)), _ranges(h)
                pick, rows, rests = [], [], []
                for k in range(i, j):
                    for x in lists[k]:
                        first = int(w.first[k - i]) + x["pos"]
                        last = first + x["n"]
                        mid = first + int(np.argmax(g[first : first + window - anchor + 1] == x["m"]))
                        m = np.array([x["m"]], np.int64).view(np.uint64)
                        lefts, rights = np.arange(mid - 1, first - 1, -1), np.arange(mid + anchor + 1, last + 1)
                        rests.append(signed(_chain(sums, lefts, np.full(len(lefts), mid), m, np.ones(1))))
                        rests.append(signed(_chain(sums, np.full(len(rights), mid), rights, m, np.zeros(1))))
                        for side in (0, 1):
                            pick.append(k)
                            rows.append((x["m"], x["c"], x["pos"], mid - first, side))
                m, c, pos, at, side = zip(*rows, strict=True) if rows else [()] * 5
                ends = np.append(0, np.cumsum([len(x) for x in rests])).astype(np.int32)
                held = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rests) if rests else np.zeros(0, np.int64)))
                ints = [pa.array(x, pa.int32()) for x in (pos, at, side)]
                pick = pa.array(pick, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(m, pa.int64()), pa.array(c, pa.int64()), b.column("doc_id").take(pick), b.column("tag").take(pick), *ints, held], ["m", "c", "doc_id", "tag", "pos", "at", "side", "rest"])

    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sides that come sorted by ``rest``: far, how many entries of rest a neighbour
    shares at least, and key, the last of them. The first and the last row of a partition
    keep their rest, as a neighbour of theirs is elsewhere."""
    names = ["m", "c", "doc_id", "tag", "pos", "at", "side"]
    part = TaskContext.get().partitionId()
    held, before = None, 0

    def out(b: pa.RecordBatch, lists: list, shared: np.ndarray, first: bool, last: bool) -> pa.RecordBatch:
        n = b.num_rows
        far = np.maximum(shared[:-1], shared[1:])
        key = [int(x[k - 1]) if k else 0 for x, k in zip(lists, far.tolist(), strict=True)]
        edge = [[], []]
        for i, flag in ((0, first), (1, last)):
            edge[i] = np.zeros(n, bool)
            edge[i][-i] = flag
        rest = [x.tolist() if e else None for x, e in zip(lists, (edge[0] | edge[1]).tolist(), strict=True)]
        own = [b.column(c) for c in names]
        return pa.RecordBatch.from_arrays([*own, pa.array(far, pa.int32()), pa.array(key, pa.int64()), pa.array(np.full(n, part, np.int32)), pa.array(edge[0]), pa.array(edge[1]), pa.array(rest, pa.list_(pa.int64()))], [*names, "far", "key", "part", "first", "last", "rest"])

    def same(lists: list) -> np.ndarray:
        """Entries that each list and the next one share; as each is a hash of all before it, as many as are equal."""
        return np.array([int((a[: len(b)] == b[: len(a)]).sum()) for a, b in zip(lists, lists[1:], strict=False)], np.int64)

    def arrays(b: pa.RecordBatch) -> list:
        rest = b.column("rest")
        flat, at = rest.flatten().to_numpy(), np.append(0, np.cumsum(rest.value_lengths().to_numpy()))
        return [flat[x:y] for x, y in zip(at, at[1:], strict=False)]

    opened = True
    for b in batches:
        if not b.num_rows:
            continue
        if held is not None:  # its last row's neighbour has come
            lists = arrays(held)
            shared = np.concatenate([[before], same(lists), same([lists[-1], arrays(b.slice(0, 1))[0]])])
            yield out(held, lists, shared, opened, False)
            before, opened = shared[-1], False
        held = b
    if held is not None:
        lists = arrays(held)
        yield out(held, lists, np.concatenate([[before], same(lists), [0]]), opened, True)


def _trimmed(sides: DataFrame, window: int, anchor: int) -> DataFrame:
    """(m, c, doc_id, tag, pos, begin, end, c2) of the segments of which at least a window's
    words may stand in another segment of the shard: those words begin:end, and a hash c2
    of them; sides: as _sides makes them, a segment once.

    Sorted by what reaches from the anchor to either side, the segment that shares most
    with another is its neighbour. So a shard of any size is spread over the tasks of a
    sort, with two rows a segment; the rows at the edges of partitions, two of each, meet
    once more.
    """
    near = stage(sides.repartitionByRange("rest", "c").sortWithinPartitions("rest", "c").mapInArrow(_neighbours, f"{_SIDE.format(kind=_kind(sides))}, far int, key long, part int, first boolean, last boolean, rest array<long>"), "sides")
    along = W.orderBy("part", "last")
    common = lambda x: F.size(F.filter(F.zip_with("rest", x, lambda a, b: a == b), lambda e: e))
    edges = near.where("first or last").withColumns({"up": F.lag("rest").over(along), "down": F.lead("rest").over(along)})
    far = F.greatest("far", F.when(F.col("first") & F.col("up").isNotNull(), common("up")), F.when(F.col("last") & F.col("down").isNotNull(), common("down")))
    columns = ["m", "c", "doc_id", "tag", "pos", "at", "side", "far", "key"]
    edges = edges.withColumn("far", far).withColumn("key", F.when(F.col("far") > 0, F.try_element_at("rest", F.col("far"))).otherwise(F.lit(0)))
    state = near.where("not (first or last)").select(columns).unionByName(edges.select(columns))
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    both = state.groupBy("m", "c", "doc_id", "tag", "pos", "at").agg(of(0, "far").alias("left"), of(1, "far").alias("right"), of(0, "key").alias("a"), of(1, "key").alias("b"))
    both = both.where(F.col("left") + F.col("right") + anchor >= window)
    begin, end = F.col("at") - F.col("left"), F.col("at") + F.col("right") + anchor
    return both.select("m", "c", "doc_id", "tag", "pos", begin.alias("begin"), end.alias("end"), F.xxhash64("a", "b", "left", "right").alias("c2"))


def _dealt(rows: DataFrame, window: int) -> DataFrame:
    """(m, c, begins, ends) of segments with a window that a smaller doc_id has, by the
    hashes of the windows; rows: (m, c, doc_id, windows). Equal windows are merged by a
    partial minimum, and those that make a large share of all are joined by broadcast."""
    rows = stage(rows, "windows")
    total = rows.agg(F.coalesce(F.sum(F.size("windows")), F.lit(0))).first()[0]
    each = rows.select("m", "c", "doc_id", F.posexplode("windows").alias("at", "w"))
    first = each.groupBy("m", "w").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("last > first").select("m", "w", "first", "n")
    hot = F.col("n") * HOT >= total
    marked = each.join(F.broadcast(first.where(hot).drop("n")), ["m", "w"], "left")
    cold = marked.where("first is null").select("m", "w", "c", "doc_id", "at").join(first.where(~hot).drop("n"), ["m", "w"])
    known = marked.where("doc_id > first").select("m", "c", "at").unionByName(cold.where("doc_id > first").select("m", "c", "at"))
    known = known.groupBy("m", "c").agg(F.sort_array(F.collect_list("at")).alias("begins"))
    return known.select("m", "c", "begins", F.transform("begins", lambda x: x + window).alias("ends"))


def _trim(m: np.ndarray, texts: pa.Array, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each segment, the range of words that windows of another segment of its shard
    may hold. Segments of a shard stand aligned at their least anchor; what reaches from
    there to a word is shared only if it stands in two of them."""
    w = words(texts)
    h = w.hashes()
    g = runs(h, anchor)
    owner = w.owner()
    ok = whole_runs(w.first, anchor)
    hit = np.flatnonzero(ok & (signed(g) == m[owner[: len(g)]]))
    place = np.full(len(m), -1)
    # of equal anchors the leftmost in the run's first window is the one of all its windows
    reach = hit - w.first[owner[hit]] <= window - anchor
    place[owner[hit[reach]][::-1]] = hit[reach][::-1]
    lost = place < 0
    place[lost] = w.first[:-1][lost]
    sums = _ranges(h)
    q = np.arange(len(h))
    mid = place[owner]
    left = q < mid
    chain = _chain(sums, np.minimum(q, mid), np.where(left, mid, q + 1), m.view(np.uint64)[owner], left)
    _, back, count = np.unique(chain, return_inverse=True, return_counts=True)
    common = count[back] > 1
    begin = np.minimum.reduceat(np.where(left & common, q, mid), w.first[:-1])
    end = np.maximum.reduceat(np.where(~left & common, q + 1, mid), w.first[:-1])
    begin, end = begin - w.first[:-1], end - w.first[:-1]
    begin[lost], end[lost] = 0, w.counts()[lost]
    return begin, end


def _match(window: int, anchor: int):
    """Matching of the segments of each shard, which come by m and doc_id."""

    def group(docs: list, cs: list, texts: list, begin: list, end: list) -> Iterator[tuple[int, int, list, list]]:
        shard, i = Automaton(), 0
        while i < len(docs):
            j = i
            while j < len(docs) and docs[j] == docs[i]:
                j += 1
            later = []
            for k in range(i, j):
                part = texts[k].encode().split()[begin[k] : end[k]]
                ends = list(shard.ends(part, window)) if len(shard.next) > 1 else []
                if ends:
                    found = merged(ends, window)
                    yield k, cs[k], [a + begin[k] for a, _ in found], [b + begin[k] for _, b in found]
                if len(ends) < len(part) - window + 1:  # all words may be covered, and a window still be new
                    later.append(part)
            for part in later:
                shard.add(part)
            i = j

    def flush(t: pa.Table) -> Iterator[pa.RecordBatch]:
        m = t.column("m").to_numpy()
        texts = strings(t.column("words"))
        begin, end = _trim(m, texts, window, anchor)
        kept = np.flatnonzero(end - begin >= window)
        m, begin, end = m[kept], begin[kept].tolist(), end[kept].tolist()
        docs, cs, texts = t.column("doc_id").take(kept).to_pylist(), t.column("c").take(kept).to_pylist(), texts.take(pa.array(kept)).to_pylist()
        out: dict[str, list] = {"m": [], "c": [], "begins": [], "ends": []}
        edge = np.flatnonzero(np.append(True, m[1:] != m[:-1])).tolist() if len(m) else []
        for a, b in pairwise([*edge, len(m)]):
            if b - a > 1:
                for _, c, begins, ends in group(docs[a:b], cs[a:b], texts[a:b], begin[a:b], end[a:b]):
                    for key, x in (("m", int(m[a])), ("c", c), ("begins", begins), ("ends", ends)):
                        out[key].append(x)
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(out["m"], pa.int64()), pa.array(out["c"], pa.int64()), pa.array(out["begins"], ints), pa.array(out["ends"], ints)], ["m", "c", "begins", "ends"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            at = 0
            while at < b.num_rows:
                part = b.slice(at, 2048)
                at += part.num_rows
                if n * window >= CHUNK and held:  # up to the last change of shard
                    m = part.column("m").to_numpy()
                    cut = np.flatnonzero(np.append(held[-1].column("m")[-1].as_py(), m[:-1]) != m)
                    if len(cut):
                        held.append(part.slice(0, cut[0]))
                        yield from flush(pa.Table.from_batches(held))
                        held, n, part = [], 0, part.slice(cut[0])
                held.append(part)
                n += part.num_rows
        if n:
            yield from flush(pa.Table.from_batches(held))

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        total, removed, kept = [], [], []
        for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
            parts = (text or "").encode().split()
            n = len(parts)
            if spans:
                mark = np.zeros(n + 1, np.int32)
                np.add.at(mark, np.minimum([x["begin"] for x in spans], n), 1)
                np.add.at(mark, np.minimum([x["end"] for x in spans], n), -1)
                stay = np.cumsum(mark[:n]) == 0
                parts = [p for p, s in zip(parts, stay.tolist(), strict=True) if s]
            total.append(n)
            removed.append(n - len(parts))
            kept.append(b" ".join(parts).decode())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): texts without the words that a window of
    ``window`` words covers whose words also start in a document with a smaller doc_id.

    1. Each text is cut into segments, runs of windows with the same least anchor (a run
       of ``anchor`` words); equal windows have equal anchors, so an anchor's segments
       are a shard. About one row per 20 words; words stay where they are.
    2. Equal segments are merged by a partial minimum, so copies cost no more than one:
       those of documents after the first are covered whole. The segments that hold a
       large share of all rows go back to their documents without a shuffle.
    3. In a shard with several different segments, in the order of doc_id, each is
       streamed through a suffix automaton of the earlier ones; where the matching
       statistic reaches ``window``, words are covered. Then it joins the reference.
       Before, each loses the words that no other segment of the shard can share.
       The segments of a shard of more than SHARD, that of a very common passage, are
       trimmed like that before, in the table, and what is then equal is merged. If still
       more than SHARD differ, they are dealt by the hashes of their windows instead of
       streamed, at most window - anchor + 1 of each: known are those that a smaller
       doc_id has. The result is the same.
    4. Covered spans go back to all documents that hold the segment.

    Windows are judged on the input. Null texts have no words. A null doc_id is neither
    smaller nor larger than another: nothing is removed there and nothing for its sake.
    Repeated rows of a doc_id aren't smaller than each other; all stay.
    """
    anchor, kind = min(anchor, window), _kind(docs)
    d = docs.select("doc_id", "text").withColumn("tag", (F.xxhash64(F.coalesce("text", F.lit(""))) % (1 << 30)).cast("int"))
    seg = stage(segments(d, window, anchor), "segments")
    only = seg.groupBy("m", "c").agg(F.min(F.struct("doc_id", "tag", "pos", "n")).alias("f"), F.max("doc_id").alias("last"), F.count("*").alias("rows"))
    only = only.select("m", "c", "f.*", "last", "rows")
    shared = only.where("last > doc_id").select("m", "c", "rows", F.col("doc_id").alias("owner"), F.lit(None).cast("array<int>").alias("begins"), F.lit(None).cast("array<int>").alias("ends"))
    large = stage(seg.groupBy("m").count().where(F.col("count") > SHARD).select("m"), "large")
    varied = only.join(small(large, 16), "m", "left_anti").withColumn("n_in", F.count("*").over(W.partitionBy("m"))).where("n_in > 1")
    columns = ["m", "c", "doc_id", "tag", "pos", "n"]

    def holding(some: DataFrame, how: str) -> DataFrame:
        wanted = some.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("m", "c", "pos", "n")).alias("wanted"))
        return d.join(wanted, ["doc_id", "tag"], how).select("doc_id", "tag", "text", "wanted")

    def matched(some: DataFrame) -> DataFrame:
        texts = holding(some, "left").mapInArrow(_texts, f"m long, c long, doc_id {kind}, words string")
        return texts.repartition("m").sortWithinPartitions("m", "doc_id", "c").mapInArrow(_match(window, anchor), "m long, c long, begins array<int>, ends array<int>")

    if large.isEmpty():
        found = matched(varied.select(columns))
    else:
        sides = holding(only.join(small(large, 16), "m", "left_semi"), "inner").mapInArrow(_sides(window, anchor), f"{_SIDE.format(kind=kind)}, rest array<long>")
        members = stage(_trimmed(sides, window, anchor), "members")
        first = members.groupBy("m", "c2").agg(F.min(F.struct("doc_id", "tag", (F.col("pos") + F.col("begin")).alias("pos"), (F.col("end") - F.col("begin")).alias("n"))).alias("f"))
        first = stage(first.select("m", F.col("c2").alias("c"), "f.*"), "first")
        sizes = stage(first.groupBy("m").agg(F.count("*").alias("n_in")).where("n_in > 1"), "sizes")
        some = first.join(small(sizes, 24), "m")
        dealt = holding(some.where(F.col("n_in") > SHARD), "inner").mapInArrow(_windows(window), f"m long, c long, doc_id {kind}, windows array<long>")
        found = stage(matched(varied.select(columns).unionByName(some.where(F.col("n_in") <= SHARD).select(columns))).unionByName(_dealt(dealt, window)), "found")
        of = stage(first.select("m", "c", F.col("doc_id").alias("owner")).join(found, ["m", "c"], "left").withColumnRenamed("c", "c2"), "owners")
        moved = lambda c: F.transform(c, lambda x: x + F.col("begin"))
        whole = F.col("doc_id") > F.col("owner")
        again = members.join(small(of, 512), ["m", "c2"]).select("m", "c", F.when(whole, F.array("begin")).otherwise(moved("begins")).alias("begins"), F.when(whole, F.array("end")).otherwise(moved("ends")).alias("ends"))
        found = found.join(small(large, 16), "m", "left_anti").unionByName(again.where("begins is not null"))
    spans = shared.unionByName(found.withColumn("owner", F.lit(None).cast(kind)).withColumn("rows", F.lit(0).cast("long"))).groupBy("m", "c").agg(F.max("rows").alias("rows"), F.max("owner").alias("owner"), F.max("begins").alias("begins"), F.max("ends").alias("ends"))
    hot = F.col("rows") * HOT >= seg.count()
    marked = seg.join(F.broadcast(spans.where(hot).withColumnRenamed("rows", "hot")), ["m", "c"], "left")
    cold = marked.where("hot is null").select(*seg.columns).join(spans.where(~hot).withColumn("hot", F.lit(0)), ["m", "c"])
    hit = marked.where("hot is not null").unionByName(cold.select(*marked.columns))
    whole = F.array(F.struct(F.lit(0).alias("begin"), F.col("n").alias("end")))
    part = F.arrays_zip(F.col("begins").alias("begin"), F.col("ends").alias("end"))
    # a document after the first that holds the segment loses it whole; the first one what the automaton has found
    each = F.when(F.col("doc_id") > F.col("owner"), whole).when(F.col("begins").isNotNull(), part)
    hit = hit.select("doc_id", "tag", F.transform(each, lambda x: F.struct((x["begin"] + F.col("pos")).alias("begin"), (x["end"] + F.col("pos")).alias("end"))).alias("spans")).where("spans is not null")
    hit = hit.groupBy("doc_id", "tag").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return d.join(hit, ["doc_id", "tag"], "left").select("doc_id", "text", "spans").mapInArrow(_cut, f"doc_id {kind}, n_words long, n_removed long, kept_text string")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
x AS (SELECT r, doc_id, i, w[i] AS word, CASE WHEN i + 49 <= len(w) THEN md5(array_to_string(w[i:i + 49], ' ')) END AS h FROM p),
f AS (SELECT h, min(doc_id) AS least FROM x WHERE h IS NOT NULL GROUP BY h),
y AS (SELECT r, i, word, coalesce(max(CASE WHEN f.least < doc_id THEN i END) OVER (PARTITION BY r ORDER BY i) > i - 50, FALSE) AS gone FROM x LEFT JOIN f USING (h)),
k AS (SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM y GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r)
"""
