"""N-gram Jaccard join: documents whose sets of word shingles overlap by ``percent`` of their union are linked.

* Equal sets are one class, counted before anything else moves; classes stand for all their copies from there on.
* Classes are dealt out without losing a link: two linked sets differ in at most d shingles, d given by their size band. If
  shingles are hashed to groups, at most d groups differ in content; the contents of its filled groups are a set's keys. There
  are as many groups as the smallest sets of a band need to fill more than d of them nearly always; a set that fills no
  more than d gets one more key, common to its band. So linked classes share a key of their band, and all but d of their keys.
  Only keys that two classes share go on, and only classes that share as many as a link needs; classes connected by what
  is left form a family.
* In a family, shingles are hashed to groups and the group counts are points of an R-tree. The overlap of two sets is at
  most the sum of their coordinate minima; against the largest counts below a tree node the same sum prunes whole nodes.
  This is done first on the counts alone, in size bands of each family: what survives connects far smaller families, and
  only their sets are read again.
* There the same tree proposes pairs, which are verified on the sets: all of them for ``join``, which gives every link between
  unequal sets once; for ``components`` only those that are not connected yet.
* Families larger than a task are cut into chunks; pairs of chunks are dealt out to the tasks one by one. Two different chunks
  are only compared with each other, each chunk with itself once.

Words are runs without ASCII white space, A-Z lower-cased. With fewer than ``size`` words the whole sequence is one shingle.

Defined results: NULL, empty and blank texts have no shingle, are linked with nothing and are their own component; copies
share a component whose id is the smallest document id (NULL ids last; NULL if there is no other); repeated rows get equal
rows each; an empty table gives no rows; further columns are not read, and ``representatives`` keeps them as they came.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deadhead.llm.common import buffer_hashes, free_name, lengths_to_starts, materialize, mixed, partitions, texts, tidied, window_hashes, word_starts
from deadhead.llm.components import components as connected

#: Least ratio of the largest and smallest set of a size band; it is above 100 / percent, too.
BAND = 1.5
#: Deviations by which the smallest sets of a band should fill more groups than linked sets may differ in.
MARGIN = 5.0
#: Shingles of one chunk of a family.
CHUNK = 4_000_000
#: Keys that a task holds before it sends them, keys of one bucket, and about how many a shingle makes per 10 % of difference.
HELD, BUCKET, KEYS_PER_SHINGLE = 1_000_000, 2_000_000, 0.17
LEAF = 16
#: Another round over shared keys is worth it if the last one left at most so much.
SHRINKING = 0.8
#: Sets of one chunk when only their counts are looked at.
POINTS = 8192
_FIRST, _SECOND, _GROUP, _CONTENT = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def shingles(raw: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    spaced = [b" ".join(t.lower().split()) for t in raw]
    counts = np.array([t.count(b" ") + 1 if t else 0 for t in spaced], np.int64)
    buffer = b" ".join([t for t in spaced if t])
    values = buffer_hashes(buffer, word_starts(buffer))
    runs = mixed(window_hashes(values, size))
    found = []
    for a, n in zip(lengths_to_starts(counts)[:-1].tolist(), counts.tolist(), strict=True):
        if n >= size:
            found.append(np.unique(runs[a : a + n - size + 1]))
        elif n:
            found.append(mixed(window_hashes(values[a : a + n], n) + np.uint64(n)))
        else:
            found.append(values[:0])
    return found


def _ratio(percent: int) -> float:
    return max(BAND, 105 / percent)


def band_of(n: int, percent: int) -> int:
    return int(np.floor(np.log(n) / np.log(_ratio(percent)) + 1e-9))


def band_differences(band: int, percent: int) -> int:
    """Most shingles in which two linked sets may differ if the larger one is of this band."""
    largest = int(np.ceil(_ratio(percent) ** (band + 1) + 1e-9))
    # |A| + |B| = union + overlap >= (1 + p) union, and (1 - p) union differ
    return 2 * largest * (100 - percent) // (100 + percent)


@functools.lru_cache(maxsize=4096)
def key_groups(band: int, percent: int) -> int:
    """Groups for the keys of a band: the fewest that its smallest sets nearly always fill more of than may differ."""
    wanted = band_differences(band, percent) + 1
    least = max(2, int(_ratio(percent) ** band * percent / 100))
    groups = wanted + 1
    while groups < 64 * least:
        one, two = (1 - 1 / groups) ** least, (1 - 2 / groups) ** least
        spread = groups * (groups - 1) * two + groups * one - (groups * one) ** 2
        if groups * (1 - one) - MARGIN * np.sqrt(max(spread, 0.0)) >= wanted:
            break
        groups += max(1, groups // 32)
    return groups


def keys(own: np.ndarray, percent: int) -> list[tuple[int, int, np.ndarray]]:
    """Per band of the larger of two sets: the band, how many keys a linked set at least shares, and the keys.

    Keys are hashes of which two linked, unequal sets share one, and all but so many as they may differ in.
    """
    n, out = len(own), []
    first = band_of(n, percent) if n else 0
    for band in (first, first + 1) if n else ():
        if band > first and n * 100 / percent < _ratio(percent) ** band - 1e-6:
            continue  # no partner is that large
        d = band_differences(band, percent)
        if d == 0:
            continue  # only equal sets are linked
        groups = key_groups(band, percent)
        at = ((own * _GROUP) >> np.uint64(33)) % np.uint64(groups)
        content = np.zeros(groups, np.uint64)
        np.add.at(content, at.astype(np.int64), mixed(own * _CONTENT))
        filled = np.bincount(at.astype(np.int64), minlength=groups) > 0
        place = np.flatnonzero(filled).astype(np.uint64) + np.uint64(band << 32)
        found = mixed(content[filled] ^ mixed(place * _SECOND))
        if len(found) <= d:  # all of its groups may differ
            out.append((band, 1, np.append(found, mixed(np.array([band], np.uint64) * _SECOND + _FIRST))))
        else:
            out.append((band, len(found) - d, found))
    return out


def _sum(own: np.ndarray, salt: np.uint64) -> int:
    return int(mixed(own * salt).sum(dtype=np.uint64).view(np.int64))


def _level(n: int, percent: int) -> int:
    """Linked sets are of the same or of neighbouring levels."""
    return int(np.floor(np.log(n) / np.log(100 / percent) + 1e-9))


def _groups(level: int, percent: int) -> int:
    """Groups that sets of a level are counted in: a power of two, about a quarter of their size."""
    return 1 << int(np.clip(np.round(level * np.log2(100 / percent) - 2), 4, 10))


def _point(own: np.ndarray, percent: int) -> bytes:
    """Group counts of a set, as fine as the next level counts."""
    if not len(own):
        return b""
    groups = _groups(_level(len(own), percent) + 1, percent)
    return counts([own], groups)[0].astype("<u4").tobytes()


def _profile(source: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, mark, n, a, b, point): the number of shingles, two sums of their hashes, which tell sets apart, and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sets = shingles(texts(batch.column("text")), size)
                made = {"n": [len(s) for s in sets], "a": [_sum(s, _FIRST) for s in sets], "b": [_sum(s, _SECOND) for s in sets]}
                columns = [batch.column("doc_id"), batch.column("mark"), *(pa.array(v, pa.int64()) for v in made.values())]
                points = pa.array([_point(s, percent) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, points], names=["doc_id", "mark", *made, "point"])

    kind = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType), *T.StructType.fromDDL("mark long, n long, a long, b long, point binary")])
    return materialize(source.mapInArrow(tidied(run), kind), "jaccard-profile")


def _once(key: np.ndarray, node: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different (key, node) in order; of ``more`` the largest of equal ones."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    fresh = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))) if len(key) else order
    return key[fresh], node[fresh], *(np.maximum.reduceat(m[order], fresh) if len(fresh) else m for m in more)


def _shared_keys(source: DataFrame, size: int, percent: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Keys that sets share, as (key, a, band), and how many of them a linked set needs, as (a, band, need).

    Keys meet in buckets as packed arrays. Sets of one task with the same key are known to share it and send the key once,
    so a key that a third of all sets has costs its bucket a row per ``HELD`` keys. Keys of a single set, by far the most,
    end here.
    """
    kind = "bucket int, part binary"

    def pack(bucket: int, key: np.ndarray, node: np.ndarray, band: np.ndarray, flag: np.ndarray) -> pa.RecordBatch:
        raw = np.array([len(key)], "<i8").tobytes() + key.astype("<u8").tobytes() + node.astype("<i8").tobytes() + band.astype("i1").tobytes() + flag.astype("u1").tobytes()
        return pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "part": pa.array([zstandard.compress(raw, 1)], pa.binary())})

    def unpack(part: bytes) -> tuple[np.ndarray, ...]:
        raw = zstandard.decompress(part)
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        return np.frombuffer(raw, "<u8", n, 8), np.frombuffer(raw, "<i8", n, 8 + 8 * n), np.frombuffer(raw, "i1", n, 8 + 16 * n), np.frombuffer(raw, "u1", n, 8 + 17 * n)

    def flush(key: np.ndarray, node: np.ndarray, band: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, node, band = _once(key, node, band)
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        several = np.append(np.diff(np.flatnonzero(fresh)), len(key) - np.flatnonzero(fresh)[-1]) > 1
        if not fresh.all():
            yield pack(-1 - int(node[0] % buckets), key[~fresh], node[~fresh], band[~fresh], np.ones(np.count_nonzero(~fresh)))
        key, node, band = key[fresh], node[fresh], band[fresh]
        bucket = ((key >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = lengths_to_starts(np.bincount(bucket, minlength=buckets))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            own = order[edges[k] : edges[k + 1]]
            yield pack(k, key[own], node[own], band[own], several[own])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, needs = [], 0, []
        for batch in batches:
            for own in shingles(texts(batch.column("text")), size) if batch.num_rows else ():
                a = _sum(own, _FIRST)
                for band, need, found in keys(own, percent):
                    held.append((found, np.full(len(found), a), np.full(len(found), band)))
                    needs.append((need, a, band))
                    total += len(found)
            if total >= HELD:
                yield from flush(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held, total = [], 0
        if total:
            yield from flush(*(np.concatenate(x) for x in zip(*held, strict=True)))
        if needs:
            need, a, band = (np.array(x, np.int64) for x in zip(*needs, strict=True))
            yield pack(-1 - buckets - int(a[0] % buckets), need, a, band, np.zeros(len(a)))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["bucket"] != bucket:
                    yield from shared(bucket, held)
                    bucket, held = r["bucket"], []
                if bucket < 0:
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "part": pa.array([r["part"]], pa.binary())})
                else:
                    held.append(unpack(r["part"]))
        yield from shared(bucket, held)

    def shared(bucket: int | None, held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        if held:
            key, node, band, flag = _once(*(np.concatenate(x) for x in zip(*held, strict=True)))
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            group = np.repeat(np.arange(len(first)), np.diff(first, append=len(key)))
            some = ((np.bincount(group) > 1) | (np.bincount(group, weights=flag) > 0))[group]
            if some.any():
                yield pack(-1, key[some], node[some], band[some], flag[some])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column("part").to_pylist():
                key, node, band, _ = unpack(part)
                yield pa.RecordBatch.from_pydict({"key": pa.array(key.view("<i8")), "a": pa.array(node), "band": pa.array(band.astype(np.int32))})

    sent = source.select("text").mapInArrow(tidied(send), kind)
    met = materialize(sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(tidied(meet), kind), "jaccard-keys")
    found = met.filter(F.col("bucket") >= -buckets).mapInArrow(tidied(rows), "key long, a long, band int").distinct()
    needs = met.filter(F.col("bucket") < -buckets).mapInArrow(tidied(rows), "key long, a long, band int")
    return found, needs.groupBy("a", "band").agg(F.min("key").alias("need"))


def _stars(source: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    """(u, v) between the ``a`` of sets that share a key, each with the smallest of its key.

    A set that shares fewer keys with all others together than a link needs is linked with none. Such sets, and then the
    keys that only they shared, go before families are formed, again and again while that makes the rest much smaller. So
    texts that have a passage in common are not chained.
    """
    found, needs = _shared_keys(source, size, percent, buckets)
    needs = materialize(needs, "jaccard-needs")
    found = materialize(found, "jaccard-shared-keys")
    n = found.count()
    while n:
        enough = found.groupBy("a", "band").agg(F.count("*").alias("k")).join(needs, ["a", "band"]).filter("k >= need").select("a", "band")
        kept = found.join(enough, ["a", "band"])
        shared = kept.groupBy("key").agg(F.count("*").alias("k"), F.min("a").alias("least")).filter("k > 1").select("key", "least")
        found = materialize(kept.drop("least").join(shared, "key").select("key", "a", "band", "least"), "jaccard-shared-keys")
        before, n = n, found.count()
        if n > before * SHRINKING:
            break
    if "least" not in found.columns:
        found = found.withColumn("least", F.col("a"))
    return found.filter("a <> least").select(F.col("least").alias("u"), F.col("a").alias("v")).distinct()


class Tree:
    """A packed R-tree over group counts, points in order of their set sizes: per node the largest counts below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.sizes, self.levels = sizes, [points]
        while len(self.levels[-1]) > LEAF:
            below = self.levels[-1]
            self.levels.append(np.maximum.reduceat(below, np.arange(0, len(below), LEAF), axis=0))

    def partners(self, own: np.ndarray, n: int, first: int, percent: int) -> np.ndarray:
        """Points from ``first`` on, none smaller than ``n``, whose sum of coordinate minima with ``own`` allows a link."""
        last = int(np.searchsorted(self.sizes, n * 100 / percent + 1e-6, "right"))
        if first >= last:
            return np.empty(0, np.int64)
        nodes = np.arange(len(self.levels[-1]))
        for level in range(len(self.levels) - 1, -1, -1):
            width = LEAF**level
            nodes = nodes[((nodes + 1) * width > first) & (nodes * width < last)]
            least = self.sizes[np.maximum(nodes * width, first)]  # the smallest set below a node
            bound = np.minimum(self.levels[level][nodes], own).sum(axis=1)
            nodes = nodes[bound * (100 + percent) >= percent * (n + least)]
            if level:
                below = len(self.levels[level - 1])
                nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
                nodes = nodes[nodes < below]
        return nodes


class Forest:
    """Which of some sets are connected so far."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self, of: np.ndarray) -> np.ndarray:
        found = self.parent[of]
        while True:
            above = self.parent[found]
            if np.array_equal(above, found):
                break
            found = above
        self.parent[of] = found
        return found

    def join(self, root: int, other: int) -> None:
        self.parent[other] = root


def candidates(points: np.ndarray, sizes: np.ndarray, side: np.ndarray | None, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each set with those that the tree does not keep apart from it, every pair once; only between two sides, if given."""
    if side is None:
        order = np.argsort(sizes, kind="stable")
        tree = Tree(points[order], sizes[order])
        for k, q in enumerate(order.tolist()):
            yield q, order[tree.partners(points[q], int(sizes[q]), k + 1, percent)]
        return
    halves = [np.flatnonzero(side == s) for s in np.unique(side)]
    halves = [h[np.argsort(sizes[h], kind="stable")] for h in halves]
    for mine, other, where in zip(halves, halves[::-1], ("left", "right"), strict=False) if len(halves) == 2 else ():
        tree = Tree(points[other], sizes[other])
        for q, first in zip(mine.tolist(), np.searchsorted(sizes[other], sizes[mine], where).tolist(), strict=True):
            yield q, other[tree.partners(points[q], int(sizes[q]), first, percent)]


def counts(sets: list[np.ndarray], groups: int | None = None) -> np.ndarray:
    """Group counts of each set; the number of groups follows the typical size."""
    groups = groups or 1 << int(np.clip(np.ceil(np.log2(max(2.0, np.median([len(s) for s in sets]) / 2))), 4, 10))
    at = [((s * _SECOND) >> np.uint64(40)).astype(np.int64) % groups for s in sets]
    return np.array([np.bincount(a, minlength=groups) for a in at], np.int32)


def links(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Every verified link of these sets once, as a set and its partners; only between different sides, if given."""
    sizes = np.array([len(s) for s in sets])
    at = lengths_to_starts(sizes)
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(len(names), bool)
    for q, others in candidates(counts(sets), sizes, side, percent):
        if len(others):
            marked[flat[at[q] : at[q + 1]]] = True
            both = np.array([np.count_nonzero(marked[flat[at[p] : at[p + 1]]]) for p in others.tolist()])
            marked[flat[at[q] : at[q + 1]]] = False
            others = others[both * 100 >= percent * (sizes[q] + sizes[others] - both)]
        if len(others):
            yield q, others


def forest(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Verified links that connect what all links of these sets connect; only links between different sides, if given."""
    sizes = np.array([len(s) for s in sets])
    group, found = Forest(len(sets)), []
    for q, others in candidates(counts(sets), sizes, side, percent):
        root = int(group.roots(np.array([q]))[0])
        for p in others[group.roots(others) != root].tolist():
            other = int(group.roots(np.array([p]))[0])
            if other == root:
                continue
            both = len(np.intersect1d(sets[q], sets[p], assume_unique=True))
            if both * 100 >= percent * (sizes[q] + sizes[p] - both):
                found.append((q, p))
                group.join(root, other)
    return found


def _possible(members: DataFrame, percent: int) -> DataFrame:
    """(u, v) between classes of (family, cid, n, point) that connect what their counts do not keep apart.

    Sets meet in their own level and the next one, where the smaller of two linked sets of different levels waits for
    the larger.
    """
    level = F.floor(F.log("n") / float(np.log(100 / percent)) + 1e-9).cast("int")
    placed = members.withColumn("level", F.explode(F.array(level, level + 1)))
    sizes = placed.groupBy("family", "level").agg(F.ceil(F.count("*") / POINTS).cast("int").alias("chunks"), F.count("*").alias("k"))
    dealt = placed.join(sizes.filter("k > 1").drop("k"), ["family", "level"])
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select("family", "level", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid", "n", "point")

    def run(found: pa.Table) -> pa.Table:
        groups = _groups(found.column("level")[0].as_py(), percent)
        ids, sizes = found.column("cid").to_numpy(), found.column("n").to_numpy()
        # finer counts add up to coarser ones
        points = np.stack([np.frombuffer(p, "<u4").astype(np.int64).reshape(-1, groups).sum(axis=0) for p in found.column("point").to_pylist()])
        group, u, v = Forest(len(ids)), [], []
        for q, others in candidates(points, sizes, _sides(found), percent):
            root = int(group.roots(np.array([q]))[0])
            apart, first = np.unique(group.roots(others), return_index=True)
            for other, p in zip(apart.tolist(), others[first].tolist(), strict=True):
                if other != root:
                    u.append(int(ids[q]))
                    v.append(int(ids[p]))
                    group.join(root, other)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    # the join left a family's level in one task; its pairs of chunks must not stay there
    return dealt.repartition("family", "level", "i", "j").groupBy("family", "level", "i", "j").applyInArrow(run, "u long, v long")


def _sides(found: pa.Table) -> np.ndarray | None:
    """The chunk of each row, if there are two."""
    return None if found.column("i")[0] == found.column("j")[0] else found.column("own").to_numpy()


def _family_links(members: DataFrame, percent: int, every: bool) -> DataFrame:
    """(u, v) between classes from (family, chunks, cid, set), each pair of chunks of a family in a group of its own.

    ``every``: all links, u < v, each once; else links that connect the same.
    """
    own = F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int")
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid", "set")

    def run(found: pa.Table) -> pa.Table:
        ids, side = found.column("cid").to_numpy(), _sides(found)
        sets = [np.frombuffer(s, np.uint64) for s in found.column("set").to_pylist()]
        if every:
            near = [(np.full(len(others), ids[q]), ids[others]) for q, others in links(sets, percent, side)]
            one, two = (np.concatenate([n[k] for n in near]) if near else np.empty(0, np.int64) for k in (0, 1))
        else:
            pairs = np.array(forest(sets, percent, side), np.int64).reshape(-1, 2)
            one, two = ids[pairs[:, 0]], ids[pairs[:, 1]]
        return pa.table({"u": pa.array(np.minimum(one, two), pa.int64()), "v": pa.array(np.maximum(one, two), pa.int64())})

    return dealt.repartition("family", "i", "j").groupBy("family", "i", "j").applyInArrow(run, "u long, v long")


def _linked(docs: DataFrame, doc_id: str, text: str, size: int, percent: int, chunk: int, every: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The profile, the classes of equal sets, and links (u, v) between classes: ``every`` one, or what connects the same."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    profile = _profile(source, size, percent)
    last = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    classes = profile.filter("n > 0").groupBy("a", "b", "n").agg(F.min(last).alias("first"), F.first("point").alias("point")).withColumn("cid", F.monotonically_increasing_id())
    classes = materialize(classes, "jaccard-classes")
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(partitions(docs.sparkSession), int(total * KEYS_PER_SHINGLE * (100 - percent) / 10 / BUCKET))
    stars = _stars(source, size, percent, buckets)
    shared = connected(stars, "jaccard-shared").select(F.col("node").alias("a"), F.col("root").alias("family"))
    possible = materialize(_possible(shared.join(classes, "a").select("family", "cid", "n", "point"), percent), "jaccard-possible")
    families = connected(possible, "jaccard-families").select(F.col("node").alias("cid"), F.col("root").alias("family"))
    wanted = families.join(classes, "cid").select("cid", "family", "n", F.col("first.doc_id").alias("want"), F.col("first.mark").alias("mark"))
    chunks = wanted.groupBy("family").agg(F.ceil(F.sum("n") / chunk).cast("int").alias("chunks"), F.count("*").alias("k")).filter("k > 1").drop("k")
    wanted = materialize(wanted.join(chunks, "family"), "jaccard-wanted")
    # one plan at every size: the list of classes in families grows with the input
    here = source.join(wanted.hint("merge"), (source["mark"] == wanted["mark"]) & source["doc_id"].eqNullSafe(wanted["want"])).select(source["mark"], source["doc_id"], "family", "chunks", "cid", "text")
    here = here.dropDuplicates(["mark", "doc_id"])  # repeated rows; dealt out as the join left them

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sets = [s.tobytes() for s in shingles(texts(batch.column("text")), size)]
                yield pa.RecordBatch.from_arrays([batch.column("family"), batch.column("chunks"), batch.column("cid"), pa.array(sets, pa.binary())], names=["family", "chunks", "cid", "set"])

    sets = here.select("family", "chunks", "cid", "text").mapInArrow(tidied(read), "family long, chunks int, cid long, set binary")
    return profile, classes, materialize(_family_links(sets, percent, every), "jaccard-links")


@dataclass(frozen=True)
class Join:
    """All links: those inside a class by its members, those between classes as pairs."""

    members: DataFrame  # (doc_id, mark, n_shingles, class_id) per row of the table; no class without a shingle
    pairs: DataFrame  # (one, two): linked classes of unequal sets, one < two, each pair once

    def degrees(self) -> DataFrame:
        """(doc_id, mark, n_shingles, class_id, n_links): the number of other rows that each row is linked with."""
        sizes = self.members.filter("class_id is not null").groupBy("class_id").agg(F.count("*").alias("k"))
        both = self.pairs.unionByName(self.pairs.select(F.col("two").alias("one"), F.col("one").alias("two")))
        near = both.join(sizes, both["two"] == sizes["class_id"]).groupBy("one").agg(F.sum("k").alias("near"))
        totals = sizes.join(near, F.col("class_id") == F.col("one"), "left").select("class_id", (F.col("k") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
        return self.members.join(totals, "class_id", "left").select("doc_id", "mark", "n_shingles", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90, chunk: int = CHUNK) -> Join:
    """Every linked pair of documents, as classes of equal sets and the pairs of classes."""
    profile, classes, found = _linked(docs, doc_id, text, size, percent, chunk, every=True)
    ids = classes.select("a", "b", "n", F.col("cid").alias("class_id"))
    members = profile.drop("point").join(ids, ["a", "b", "n"], "left").select("doc_id", "mark", F.col("n").alias("n_shingles"), "class_id")
    return Join(members, found.select(F.col("u").alias("one"), F.col("v").alias("two")))


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90, chunk: int = CHUNK, every: bool = False) -> DataFrame:
    """(doc_id, mark, n_shingles, component_id, kept): kept marks the one document that stands for its component.

    Only links that connect something are verified, unless ``every`` is set; the result is the same.
    """
    profile, classes, found = _linked(docs, doc_id, text, size, percent, chunk, every)
    roots = connected(found, "jaccard-components").select(F.col("node").alias("cid"), "root")
    joined = classes.drop("point").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    heads = joined.groupBy("root").agg(F.min("first").alias("head"))
    placed = joined.join(heads, "root").select("a", "b", "n", "head")
    grouped = profile.drop("point").filter("n > 0").join(placed, ["a", "b", "n"])
    kept = (F.col("mark") == F.col("head.mark")) & F.col("doc_id").eqNullSafe(F.col("head.doc_id"))
    linked = grouped.select("doc_id", "mark", F.col("n").alias("n_shingles"), F.col("head.doc_id").alias("component_id"), kept.alias("kept"))
    alone = profile.filter("n = 0").select("doc_id", "mark", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone)


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id; documents without a word all stay."""
    mark, empty = free_name(docs, "_mark"), free_name(docs, "_empty")
    found = components(docs, doc_id, text, **options).filter("kept and n_shingles > 0").select(F.col("doc_id").alias("keep_id"), F.col("mark").alias("keep_mark")).distinct()
    own = docs.withColumn(mark, F.xxhash64(text)).withColumn(empty, F.coalesce(~F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(True)))
    here = own.filter(~F.col(empty)).join(found.hint("merge"), (F.col(mark) == F.col("keep_mark")) & F.col(doc_id).eqNullSafe(F.col("keep_id")), "left_semi")
    once = here.dropDuplicates([doc_id, mark])
    return once.unionByName(own.filter(F.col(empty))).select(*docs.columns)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_shingles", "component_id")
