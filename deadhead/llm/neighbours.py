"""Nearest neighbours by inner product: multiprobe p-stable hashing with exact reranking.

* Equal vectors are one point with its ``k + 1`` smallest ids; more of them cannot be among the ``k`` nearest of any query.
* Points are scaled into the unit ball and get one more coordinate that makes their length 1; then the largest inner product
  is the smallest distance. A table hashes a point to ``floor((a.x + b) / width)`` for some random normal vectors ``a``.
* A query visits, per table, its own bucket and perturbed ones. Perturbations are visited in the order of their expected
  success: that of the usual template over the coordinates ranked by their distance to the bucket's border.
* How many are visited is set on a bounded sample of queries, whose exact neighbours are found first by a pass over all
  points: as many as reach ``recall`` of them (plus a margin). All points are indexed. Where the longest list of probes does
  not reach it, there are fewer hashes and so larger buckets; where no number of hashes does, all points are visited.
* Buckets are dealt out to parts of about ``PART`` points. A bucket with more points is spread over several parts; the list
  of such buckets has at most ``MOST`` entries for each table. In a part, the points are held and the queries stream by.
  Scores are inner products of the original vectors in double precision.
* A query that found fewer than ``k`` points visits all points.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite numbers take no part, nor do those without an id or
with another length than most; repeated rows (same id and vector) count once, and no row with the query's id is its
neighbour; ties go to the smaller id; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deadhead.llm.common import MIX, materialize, partitions

PART, MOST = 16_384, 4096
#: Points whose scores with a batch of queries are held at once.
STEP = 1024
#: Queries that the number of probes is set on.
SAMPLE = 96
#: Template entries that are looked at, at most; where they do not do, hashes are left out.
TEMPLATE = 6_000
LEAST_HASHES = 3

_ROW = "t int, p int, kind int, id long, vec binary, codes binary"


@dataclass(frozen=True)
class Hashing:
    """Random projections of all tables; ``width`` is in units of the largest vector's length."""

    size: int
    hashes: int
    tables: int = 4
    width: float = 2.5
    seed: int = 20

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        random = np.random.default_rng(self.seed)
        return random.normal(size=(self.tables, self.size + 1, self.hashes)), random.random((self.tables, self.hashes)) * self.width

    def places(self, x: np.ndarray, longest: float, query: bool) -> np.ndarray:
        """Position of each vector on each projection, in bucket widths: (table, vector, hash)."""
        lengths = np.linalg.norm(x, axis=1)
        own = x / lengths[:, None] if query else x / longest
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(1 - (lengths / longest) ** 2, 0))
        directions, shifts = self.arrays()
        return (np.einsum("nd,tdh->tnh", np.column_stack((own, last)), directions) + shifts[:, None]) / self.width


def template(hashes: int, count: int) -> list[tuple[int, ...]]:
    """The first ``count`` perturbation sets by expected score, over ranks 1 .. 2 * hashes of distance to a border."""
    m = hashes
    expected = [0.0] + [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    expected += [1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, 2 * m + 1)]
    found: list[tuple[int, ...]] = [()]
    heap = [(expected[1], (1,))]
    while heap and len(found) < count:
        score, ranks = heapq.heappop(heap)
        if all(2 * m + 1 - r not in ranks for r in ranks):  # not both borders of one coordinate
            found.append(ranks)
        last = ranks[-1]
        if last < 2 * m:
            heapq.heappush(heap, (score - expected[last] + expected[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (score + expected[last + 1], (*ranks, last + 1)))
    return found


def codes(buckets: np.ndarray) -> np.ndarray:
    """A 64-bit number for each bucket (last axis: its hashes)."""
    out = np.zeros(buckets.shape[:-1], np.uint64)
    for k in range(buckets.shape[-1]):
        out = (out ^ buckets[..., k].astype(np.int64).view(np.uint64)) * np.uint64(MIX[0])
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def probes(places: np.ndarray, sets: list[tuple[int, ...]]) -> np.ndarray:
    """Codes of the buckets that each query visits in one table, in order: (query, probe)."""
    own = np.floor(places).astype(np.int64)
    part = places - own
    n, m = places.shape
    order = np.argsort(np.concatenate((part, 1 - part), axis=1), axis=1, kind="stable")
    visited = np.repeat(own[:, None], len(sets), axis=1)
    rows = np.arange(n)
    for k, ranks in enumerate(sets):
        for r in ranks:
            border = order[:, r - 1]
            visited[rows, k, border % m] += np.where(border < m, -1, 1)
    return codes(visited)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _bytes(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in x], pa.binary())


def _from_bytes(column: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(-1, size)


class Best:
    """The best ``k`` points of some queries so far."""

    def __init__(self, queries: np.ndarray, k: int) -> None:
        self.queries, self.k = queries, k
        self.scores = np.full((len(queries), k), -np.inf)
        self.points = np.full((len(queries), k), -1, np.int64)

    def offer(self, some: np.ndarray, ids: np.ndarray, vectors: np.ndarray, allowed: np.ndarray | None) -> None:
        """Points for the queries ``some``; ``allowed``: (query, point). Exact only for those kept."""
        scores = self.queries[some] @ vectors.T
        if allowed is not None:
            scores[~allowed] = -np.inf
        # rounding of the product must not lose a tie; kept points are scored exactly below
        margin = 1e-9 * np.linalg.norm(self.queries[some], axis=1) * np.linalg.norm(vectors, axis=1).max()
        count = min(self.k, len(ids))
        cut = np.partition(scores, len(ids) - count, axis=1)[:, len(ids) - count]
        better = scores >= (np.maximum(cut, self.scores[some, -1]) - margin)[:, None]
        better &= np.isfinite(scores)
        for q in np.flatnonzero(better.any(1)).tolist():
            own, new = some[q], np.flatnonzero(better[q])
            exact = (self.queries[own] * vectors[new]).sum(axis=1)
            s, p = np.concatenate((self.scores[own], exact)), np.concatenate((self.points[own], ids[new]))
            order = np.lexsort((p, -s))[: self.k]
            self.scores[own], self.points[own] = s[order], p[order]

    def rows(self, query_ids: list[int]) -> pa.RecordBatch:
        kept = self.points >= 0
        kept &= np.isfinite(self.scores)
        return pa.RecordBatch.from_pydict(
            {
                "query_id": pa.array(query_ids, pa.int64()),
                "points": pa.array([p[m].tolist() for p, m in zip(self.points, kept, strict=True)], pa.list_(pa.int64())),
                "scores": pa.array([s[m].tolist() for s, m in zip(self.scores, kept, strict=True)], pa.list_(pa.float64())),
            }
        )


_FOUND = "query_id long, points array<long>, scores array<double>"


def _visit(size: int, k: int):
    """Parts, points before queries, to the best points of each query in each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, ready = None, [], None
        for batch in batches:
            rows = batch.to_pylist()
            at = 0
            while at < len(rows):
                r = rows[at]
                if (r["t"], r["p"]) != here:
                    here, held, ready = (r["t"], r["p"]), [], None
                end = at
                while end < len(rows) and (rows[end]["t"], rows[end]["p"], rows[end]["kind"]) == (*here, r["kind"]):
                    end += 1
                some = rows[at:end]
                at = end
                if r["kind"] == 0:
                    held += [(x["id"], x["vec"], x["codes"]) for x in some]
                elif held:
                    ready = ready or _points(held, size)
                    yield _search(ready, some, size, k)

    return run


def _points(held: list[tuple[int, bytes, bytes]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    code = np.frombuffer(b"".join(h[2] for h in held), np.int64)
    ids = np.array([h[0] for h in held], np.int64)
    order = np.lexsort((ids, code))
    return code[order], ids[order], _from_bytes([held[i][1] for i in order.tolist()], size)


def _search(points: tuple[np.ndarray, np.ndarray, np.ndarray], queries: list[dict], size: int, k: int) -> pa.RecordBatch:
    code, ids, vectors = points
    best = Best(_from_bytes([q["vec"] for q in queries], size), k)
    buckets, first = np.unique(code, return_index=True)
    of = np.searchsorted(buckets, code)
    wanted = np.zeros((len(queries), len(buckets)), bool)
    for i, q in enumerate(queries):
        visited = np.frombuffer(q["codes"], np.int64)
        if len(visited) == 0:  # all of them
            wanted[i] = True
        else:
            at = np.minimum(np.searchsorted(buckets, visited), len(buckets) - 1)
            wanted[i, at[buckets[at] == visited]] = True
    for a in range(0, len(ids), STEP):
        b = min(len(ids), a + STEP)
        some = np.flatnonzero(wanted[:, of[a] : of[b - 1] + 1].any(1))
        if len(some):
            best.offer(some, ids[a:b], vectors[a:b], wanted[some][:, of[a:b]])
    return best.rows([q["id"] for q in queries])


def _merged(found: DataFrame, k: int) -> DataFrame:
    """(query_id, points, scores): the best ``k`` distinct points over all parts and tables of a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, scores = [], []
            for parts in batch.column("parts").to_pylist():
                own = {p: s for part in parts for p, s in zip(part["points"], part["scores"], strict=True)}
                top = sorted(own.items(), key=lambda x: (-x[1], x[0]))[:k]
                points.append([p for p, _ in top])
                scores.append([s for _, s in top])
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), pa.array(points, pa.list_(pa.int64())), pa.array(scores, pa.list_(pa.float64()))], names=["query_id", "points", "scores"])

    # a query has at most a row for each part that it visits
    return found.groupBy("query_id").agg(F.collect_list(F.struct("points", "scores")).alias("parts")).mapInArrow(run, _FOUND)


def search(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", recall: float = 0.96, tables: int = 4) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found. ``is_query``: a condition on ``id``."""
    spark = vectors.sparkSession
    own = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), own.alias("vec")).filter(
        "id is not null and size(vec) > 0 and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vec, x -> x <> 0)"
    )
    common = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if common is None:
        return empty
    size = common["size"]
    rows = materialize(rows.filter(F.size("vec") == size).dropDuplicates(["id", "vec"]), "vectors")
    least = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    points = rows.withColumn("r", least).filter(F.col("r") <= k + 1).groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    points = materialize(points.select(F.col("ids")[0].alias("point"), "ids", "vec"), "points")
    count, longest = points.agg(F.count("*"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)))).first()
    queries = rows.filter(is_query)
    most = max(LEAST_HASHES, round(0.62 * math.log2(count + 1)))
    hashing, sets = _settled(_sampled(points, queries, size, k), size, most, tables, longest, recall)
    parts = max(1, -(-count // PART))
    spread = _spread(points, hashing, longest, max(PART, count // MOST))
    index = points.mapInArrow(_index(hashing, longest, parts, spread), _ROW)
    visits = queries.mapInArrow(_queries(hashing, longest, parts, spread, sets), _ROW)

    def parted(some: DataFrame, other: DataFrame) -> DataFrame:
        n = max(partitions(spark), parts * tables)
        dealt = some.unionByName(other).repartition(n, "t", "p").sortWithinPartitions("t", "p", "kind")
        return _merged(dealt.mapInArrow(_visit(size, k + 1), _FOUND), k + 1)

    # without a list of probes that does, every query is short
    found = materialize(parted(index, visits), "neighbours") if sets else spark.createDataFrame([], _FOUND)
    short = found.filter(F.size("points") < min(k + 1, count)).select("query_id")
    missing = queries.join(found.select("query_id"), queries["id"] == F.col("query_id"), "left_anti").select("id")
    again = materialize(queries.join(short.select(F.col("query_id").alias("id")).unionByName(missing).distinct(), "id"), "again")
    if not again.isEmpty():
        every = again.crossJoin(spark.range(parts).select(F.col("id").cast("int").alias("p"))).select(
            F.lit(0).alias("t"), "p", F.lit(1).alias("kind"), "id", F.col("vec"), F.lit(b"").alias("codes")
        )
        every = every.mapInArrow(_as_bytes(size), _ROW)
        rest = parted(index.filter("t = 0"), every)
        found = found.join(again.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(rest)
    flat = found.select("query_id", F.explode(F.arrays_zip("points", "scores")).alias("x")).select("query_id", F.col("x.points").alias("point"), F.col("x.scores").alias("score"))
    each = flat.join(points.select("point", "ids"), "point").select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@dataclass(frozen=True)
class Sample:
    """Some queries, and their exact neighbours: ``near[i]`` is one of query ``which[i]``."""

    queries: np.ndarray
    which: np.ndarray
    near: np.ndarray


def _sampled(points: DataFrame, queries: DataFrame, size: int, k: int) -> Sample:
    some = queries.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    x = np.array([r.vec for r in some], float).reshape(len(some), size)
    if not len(x):
        return Sample(x, np.empty(0, np.int64), x)
    ids = [r.id for r in some]

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, kept = Best(x, k + 1), {}
        for batch in batches:
            if batch.num_rows:
                own, vectors = batch.column("point").to_numpy(), _matrix(batch.column("vec"), size)
                best.offer(np.arange(len(x)), own, vectors, None)
                kept |= {int(p): v for p, v in zip(own, vectors, strict=True) if p in best.points}
        yield from [_with_vectors(best, ids, kept, size)] if (best.points >= 0).any() else []

    rows = points.select("point", "vec").mapInArrow(exact, "query_id long, point long, score double, vec binary")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "point")
    found = rows.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).collect()  # SAMPLE x (k + 1) rows
    at = {q: i for i, q in enumerate(ids)}
    return Sample(x, np.array([at[r.query_id] for r in found], np.int64), _from_bytes([r.vec for r in found], size))


def _needed(sample: Sample, hashing: Hashing, longest: float, recall: float, sets: list[tuple[int, ...]]) -> tuple[int, float]:
    """Probes for each table that reach ``recall`` on the sample, and the share of its neighbours that they reach.

    That share is below ``recall`` if all of ``sets`` do not do.
    """
    x, which = sample.queries, sample.which
    if not len(which):
        return 1, 1.0
    theirs = codes(np.floor(hashing.places(sample.near, longest, False)).astype(np.int64))
    mine = hashing.places(x, longest, True)
    first = np.full(len(which), len(sets))
    for t in range(hashing.tables):
        for a in range(0, len(x), 16):
            visited = probes(mine[t, a : a + 16], sets)
            for i in range(len(visited)):
                own = np.flatnonzero(which == a + i)
                hit = visited[i][:, None] == theirs[t, own]
                rank = np.where(hit.any(0), hit.argmax(0), len(sets))
                first[own] = np.minimum(first[own], rank)
    order = np.sort(first)
    count = int(min(len(sets), 1 + order[min(len(order) - 1, math.ceil(recall * len(order)))]))
    return count, float((first < count).mean())


def _settled(sample: Sample, size: int, most: int, tables: int, longest: float, recall: float) -> tuple[Hashing, list[tuple[int, ...]]]:
    """The most hashes, up to ``most``, with which some probes reach ``recall``, and these; no probes if none do."""
    for hashes in range(most, LEAST_HASHES - 1, -1):
        hashing = Hashing(size, hashes, tables)
        sets = template(hashes, TEMPLATE)
        count, reached = _needed(sample, hashing, longest, recall, sets)
        if reached >= recall:
            return hashing, sets[:count]
    return hashing, []




def _with_vectors(best: Best, ids: list[int], kept: dict[int, np.ndarray], size: int) -> pa.RecordBatch:
    rows = [(ids[q], int(p), float(s)) for q in range(len(ids)) for p, s in zip(best.points[q], best.scores[q], strict=True) if p >= 0]
    return pa.RecordBatch.from_pydict(
        {"query_id": [r[0] for r in rows], "point": [r[1] for r in rows], "score": [r[2] for r in rows], "vec": pa.array([kept[r[1]].tobytes() for r in rows], pa.binary())}
    )


def _spread(points: DataFrame, hashing: Hashing, longest: float, most: int) -> dict[tuple[int, int], int]:
    """Parts of each bucket with more than ``most`` points; at most ``MOST`` buckets a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = codes(np.floor(hashing.places(_matrix(batch.column("vec"), hashing.size), longest, False)).astype(np.int64))
                t = np.repeat(np.arange(hashing.tables, dtype=np.int32), found.shape[1])
                yield pa.RecordBatch.from_pydict({"t": pa.array(t), "code": pa.array(found.ravel())})

    rows = points.select("vec").mapInArrow(run, "t int, code long").groupBy("t", "code").count().filter(F.col("count") > most).collect()
    return {(r.t, r.code): -(-r["count"] // PART) for r in rows}


def _part(code: np.ndarray, parts: int) -> np.ndarray:
    return ((code.view(np.uint64) >> np.uint64(17)) % np.uint64(parts)).astype(np.int64)


def _index(hashing: Hashing, longest: float, parts: int, spread: dict[tuple[int, int], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ids = _matrix(batch.column("vec"), hashing.size), batch.column("point").to_numpy()
            found = codes(np.floor(hashing.places(x, longest, False)).astype(np.int64))
            for t in range(hashing.tables):
                p = _part(found[t], parts)
                for i in np.flatnonzero([(t, int(c)) in spread for c in found[t]]) if spread else ():
                    p[i] = (p[i] + ids[i] % spread[t, int(found[t][i])]) % parts
                yield _rows(t, p, 0, ids, x, [c.tobytes() for c in found[t]])

    return run


def _rows(t: int, p: np.ndarray, kind: int, ids: np.ndarray, x: np.ndarray, found: list[bytes]) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_pydict(
        {"t": pa.array(np.full(n, t, np.int32)), "p": pa.array(p.astype(np.int32)), "kind": pa.array(np.full(n, kind, np.int32)), "id": pa.array(np.asarray(ids, np.int64)), "vec": _bytes(x), "codes": pa.array(found, pa.binary())}
    )


def _queries(hashing: Hashing, longest: float, parts: int, spread: dict[tuple[int, int], int], sets: list[tuple[int, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ids = _matrix(batch.column("vec"), hashing.size), batch.column("id").to_numpy()
            places = hashing.places(x, longest, True)
            for t in range(hashing.tables):
                for a in range(0, len(ids), 64):
                    visited = probes(places[t, a : a + 64], sets)
                    p, who, sent = [], [], []
                    for i, own in enumerate(visited):
                        to = _part(own, parts)
                        for c in [k for k, c in enumerate(own.tolist()) if (t, c) in spread] if spread else ():
                            extra = (to[c] + np.arange(1, spread[t, int(own[c])])) % parts
                            own, to = np.append(own, np.full(len(extra), own[c])), np.append(to, extra)
                        order = np.argsort(to, kind="stable")
                        edges = np.flatnonzero(np.diff(to[order], prepend=-1, append=-1))
                        for f, g in zip(edges[:-1], edges[1:], strict=True):
                            p.append(to[order[f]])
                            who.append(a + i)
                            sent.append(own[order[f:g]].tobytes())
                    yield _rows(t, np.array(p), 1, ids[who], x[who], sent)

    return run


def _as_bytes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch.column(c) for c in ("t", "p", "kind", "id")]
            yield pa.RecordBatch.from_arrays([*kept, _bytes(_matrix(batch.column("vec"), size)), batch.column("codes")], names=["t", "p", "kind", "id", "vec", "codes"])

    return run
