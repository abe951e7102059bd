"""Approximate nearest neighbours by largest inner product over robust-pruned directed graphs.

Vectors are dealt to shards by hash. A shard gives every vector one more component that
makes all lengths equal, so the largest inner product is the least distance. Points join
the graph in growing batches: a greedy beam search proposes neighbours, robust pruning
keeps those that no kept neighbour is closer to by the factor ``alpha``, and edges are
added in both directions. A query walks every shard with a beam; the found vectors are
scored again in double precision on the given components.

Equal vectors are one point of the graph with its smallest ids, enough for any top k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialize

SHARD_ROWS = 8192
DEGREE = 32
BUILD_BEAM = 48
SEARCH_BEAM = 96
ALPHA = 1.2
WIDE = 4
QUERY_BLOCK = 1024
STARTS = 8


def usable(embedding: Column) -> Column:
    """Not null, not empty, not zero, every component a finite number."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def beam_search(q: np.ndarray, x: np.ndarray, graph: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``width`` best points found for each row of ``q``, best first (-1: none)."""
    b, rows = len(q), np.arange(len(q))[:, None]
    seen = np.zeros((b, len(x) + 1), dtype=bool)
    seen[:, -1] = True  # column of the padding id -1
    ids = np.broadcast_to(starts, (b, len(starts))).copy()
    seen[rows, ids] = True
    score = q @ x[starts].T
    fresh = np.ones(ids.shape, dtype=bool)
    while True:
        # The best points not looked at yet.
        order = np.argsort(np.where(fresh, -score, np.inf), axis=1)[:, :WIDE]
        there = fresh[rows, order]
        if not there.any():
            return ids, score
        fresh[rows, order] = False
        new = graph[np.where(there, ids[rows, order], -1)]
        new[~there] = -1
        new = new.reshape(b, -1)
        new = np.where(seen[rows, new], -1, new)
        # One point may be a neighbour of several: keep its first mention.
        line = np.sort(new, axis=1)
        line[:, 1:][line[:, 1:] == line[:, :-1]] = -1
        new = line
        seen[rows, new] = True
        value = np.einsum("bd,bkd->bk", q, x[new], optimize=False)
        value[new < 0] = -np.inf
        ids, score = np.concatenate([ids, new], axis=1), np.concatenate([score, value], axis=1)
        fresh = np.concatenate([fresh, new >= 0], axis=1)
        if ids.shape[1] > width:
            keep = np.argpartition(-score, width - 1, axis=1)[:, :width]
        else:
            keep = np.broadcast_to(np.arange(ids.shape[1]), ids.shape)
        keep = np.take_along_axis(keep, np.argsort(-score[rows, keep], axis=1, kind="stable"), axis=1)
        ids, score, fresh = ids[rows, keep], score[rows, keep], fresh[rows, keep]


def robust_prune(p: np.ndarray, cand: np.ndarray, x: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` diverse neighbours out of the candidates of each point (-1: none)."""
    b = len(p)
    cand = np.where(cand == p[:, None], -1, cand)
    cand = np.sort(cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    away = ((x[cand] - x[p][:, None, :]) ** 2).sum(axis=2)
    away[cand < 0] = np.inf
    order = np.argsort(away, axis=1, kind="stable")
    cand, away = np.take_along_axis(cand, order, 1), np.take_along_axis(away, order, 1)
    v = x[cand]
    size = (v * v).sum(axis=2)
    between = np.maximum(size[:, :, None] + size[:, None, :] - 2 * (v @ v.transpose(0, 2, 1)), 0)
    alive = cand >= 0
    out = np.full((b, degree), -1, dtype=np.int32)
    rows = np.arange(b)
    for k in range(degree):
        if not alive.any():
            break
        pick = alive.argmax(axis=1)
        some = alive[rows, pick]
        out[some, k] = cand[rows, pick][some]
        alive &= ~(some[:, None] & (alpha * alpha * between[rows, pick] <= away))
        alive[rows, pick] = False
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Neighbour lists (-1: none) of the rows of ``x`` and the points where walks start."""
    n = len(x)
    graph = np.full((n + 1, degree), -1, dtype=np.int32)  # the last row serves the id -1
    order = np.random.default_rng(seed).permutation(n)
    middle = x @ x.mean(axis=0)
    starts = np.unique(np.concatenate([[middle.argmax()], order[: STARTS - 1]])).astype(np.int64)
    order = np.concatenate([starts, order[~np.isin(order, starts)]])
    at = 0
    while at < n:
        batch = order[at : at + max(len(starts), min(at, 512))]
        if at:
            found, _ = beam_search(x[batch], x, graph, starts, beam)
        else:
            found = np.broadcast_to(starts, (len(batch), len(starts)))
        mine = robust_prune(batch, found, x, degree, alpha)
        graph[batch] = mine
        # The other direction: points whose list overflows are pruned again.
        a, b = mine.ravel(), np.repeat(batch, degree)
        a, b = a[mine.ravel() >= 0], b[mine.ravel() >= 0]
        line = np.argsort(a, kind="stable")
        a, b = a[line], b[line]
        heads, first, count = np.unique(a, return_index=True, return_counts=True)
        if len(heads):
            place = np.arange(len(a)) - np.repeat(first, count)
            wide = np.full((len(heads), int(count.max())), -1, dtype=np.int64)
            wide[np.repeat(np.arange(len(heads)), count), place] = b
            merged = np.concatenate([graph[heads].astype(np.int64), wide], axis=1)
            for k in range(0, len(heads), 512):
                cut = slice(k, k + 512)
                graph[heads[cut]] = _merge(heads[cut], merged[cut], x, degree, alpha)
        at += len(batch)
    return graph, starts


def _merge(p: np.ndarray, cand: np.ndarray, x: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Lists that fit are kept as they are; longer ones are pruned."""
    cand = np.sort(cand, axis=1)[:, ::-1]
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    cand = -np.sort(-cand, axis=1)
    long = (cand >= 0).sum(axis=1) > degree
    out = cand[:, :degree].astype(np.int32)
    if out.shape[1] < degree:
        out = np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)
    if long.any():
        out[long] = robust_prune(p[long], cand[long], x, degree, alpha)
    return out


INDEX = "shard int, dim int, n int, ids binary, counts binary, vectors binary, graph binary, starts binary"


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: its graph, distinct vectors and, for each, its k + 1 smallest ids.

    Every usable row of ``vectors`` (vec_id, embedding) with an id is indexed. Vectors of
    different lengths go to different shards.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    # Adding zero turns -0.0 into 0.0, so equal vectors are equal keys.
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).withColumn("embedding", F.transform("embedding", lambda v: v + F.lit(0.0)))
    first = Window.partitionBy("embedding").orderBy("vec_id")
    rows = rows.distinct().withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1).drop("nth")
    rows = materialize(rows, "vectors")
    shards = max(1, -(-rows.count() // shard_rows))
    rows = rows.withColumn("dim", F.size("embedding")).withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        dim, shard = table.column("dim")[0].as_py(), table.column("shard")[0].as_py()
        given = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        ids = table.column("vec_id").cast(pa.int64()).to_numpy()
        line = np.lexsort((ids, *given.T))
        given, ids = given[line], ids[line]
        new = np.concatenate([[True], (given[1:] != given[:-1]).any(axis=1)])
        counts = np.diff(np.append(np.flatnonzero(new), len(ids)))
        points = given[new]
        graph, starts = build_graph(lifted(points))
        cells = (ids.astype("<i8"), counts.astype("<i8"), points.astype("<f8"), graph.astype("<i4"), starts.astype("<i8"))
        return pa.table({
            "shard": pa.array([shard], pa.int32()), "dim": pa.array([dim], pa.int32()), "n": pa.array([len(points)], pa.int32()),
            **{name: pa.array([c.tobytes()], pa.binary()) for name, c in zip(("ids", "counts", "vectors", "graph", "starts"), cells)},
        })

    return materialize(rows.groupBy("dim", "shard").applyInArrow(build, INDEX), "graphs")


def lifted(points: np.ndarray) -> np.ndarray:
    """Vectors of one length whose products with (query, 0) are unchanged; a last row of zeros serves the id -1."""
    size = (points * points).sum(axis=1)
    longest = max(float(np.sqrt(size.max())), 1e-300)
    more = np.sqrt(np.maximum(1 - size / longest**2, 0))
    return np.concatenate([points / longest, more[:, None]], axis=1).astype(np.float32)


def search(index: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each usable row of ``queries`` (vec_id, embedding).

    A row with the query's own id is no candidate. Equal scores are ordered by vec_id.
    """
    q = queries.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    q = q.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).distinct()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.diff(batch.column("embedding").offsets.to_numpy())
            for dim in np.unique(dims):
                rows = batch.take(pa.array(np.flatnonzero(dims == dim)))
                for at in range(0, rows.num_rows, QUERY_BLOCK):
                    cut = rows.slice(at, QUERY_BLOCK)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), pa.array([cut.column("vec_id").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         pa.array([cut.column("embedding").flatten().to_numpy().astype("<f8").tobytes()], pa.binary())],
                        ["dim", "queries", "asked"],
                    )

    asked = materialize(q.mapInArrow(blocks, "dim int, queries binary, asked binary"), "query-blocks")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["dim"], row["shard"]) != shard:
                    shard = (row["dim"], row["shard"])
                    points = np.frombuffer(row["vectors"], "<f8").reshape(-1, row["dim"])
                    counts = np.frombuffer(row["counts"], "<i8")
                    held = (
                        points, lifted(points), np.frombuffer(row["graph"], "<i4").reshape(len(points) + 1, -1),
                        np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["ids"], "<i8"), counts, np.cumsum(counts) - counts,
                    )
                points, x, graph, starts, ids, counts, begins = held
                number = np.frombuffer(row["queries"], "<i8")
                given = np.frombuffer(row["asked"], "<f8").reshape(len(number), -1)
                size = np.sqrt((given * given).sum(axis=1, keepdims=True))
                lift = np.concatenate([given / size, np.zeros((len(given), 1))], axis=1).astype(np.float32)
                for at in range(0, len(number), 256):
                    found, _ = beam_search(lift[at : at + 256], x, graph, starts, beam)
                    for i, line in enumerate(found, at):
                        line = line[line >= 0]
                        score = (points[line] * given[i]).sum(axis=1)
                        best = np.argsort(-score, kind="stable")[: k + 1]
                        # All points that tie with the last one stay.
                        best = np.flatnonzero(score >= score[best[-1]])
                        many = counts[line[best]]
                        who = np.concatenate([ids[begins[p] : begins[p] + c] for p, c in zip(line[best], many)])
                        value = np.repeat(score[best], many)
                        keep = who != number[i]
                        who, value = who[keep], value[keep]
                        top = np.lexsort((who, -value))[:k]
                        if len(top):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(top), number[i])), pa.array(who[top]), pa.array(value[top])], ["query_id", "vec_id", "score"]
                            )

    # Every block of queries meets every shard: the stated query set against all rows. Both
    # sides are dealt by shard to a fixed number of tasks; searching outweighs their bytes.
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = index.agg(F.coalesce(F.max("shard"), F.lit(0))).first()[0]
    met = (
        asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(last)))).repartition(parts, "dim", "shard")
        .join(index.repartition(parts, "dim", "shard").hint("merge"), ["dim", "shard"])
        .select("dim", "shard", "queries", "asked", "vectors", "ids", "counts", "graph", "starts")
    )
    found = met.mapInArrow(walk, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The k nearest found for each row whose vec_id is divisible by ``every``, among all other rows."""
    return search(build_index(vectors, k), vectors.where(F.col("vec_id") % every == 0), k)
