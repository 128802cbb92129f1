"""Approximate nearest neighbours by learned partitions.

A bounded sample gives a neighbour graph, which recursive bisection cuts into parts of equal size
with few edges between them; a softmax classifier learns which parts a vector's neighbours lie in.
Every row goes to its most probable part, a query to as many of its most probable parts as the
sample needs for the recall aimed at, and what lies there is reranked by the exact inner product.
Parts are cut into blocks of rows and queries into chunks, so no task holds more than a block and a
chunk, however large or asked-for a part is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import read, written

#: Vectors that the partition and the classifier are fitted on, at most; every row is indexed whatever it is.
SAMPLE = 6000
#: Rows per part aimed at; parts, a power of two between these.
PART_ROWS, LEAST_PARTS, MOST_PARTS = 3200, 8, 256
NEIGHBOURS, RECALL = 12, 0.94
BLOCK, QUERY_CHUNK = 8192, 2048


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of each row's k nearest others by inner product."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for lo in range(0, len(x), 1024):
        near = x[lo : lo + 1024] @ x.T
        near[np.arange(len(near)), lo + np.arange(len(near))] = -np.inf
        out[lo : lo + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else out[lo : lo + 1024]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 30) -> np.ndarray:
    """Parts of equal size (within one) by recursive bisection: a split at the median of the main direction, then swaps that cut fewer edges."""
    label = np.zeros(len(x), np.int64)
    heads = np.repeat(np.arange(len(x)), graph.shape[1])
    tails = graph.ravel()
    step = parts
    while step > 1:
        step //= 2
        for part in range(0, parts, 2 * step):
            own = np.flatnonzero(label == part)
            if len(own) < 2:
                continue
            centred = x[own] - x[own].mean(axis=0)
            main = np.linalg.svd(centred.T @ centred)[0][:, 0]
            side = np.zeros(len(own), bool)
            side[np.argsort(centred @ main)[len(own) // 2 :]] = True
            place = np.full(len(x), -1)
            place[own] = np.arange(len(own))
            inside = (place[heads] >= 0) & (place[tails] >= 0)
            u, v = place[heads[inside]], place[tails[inside]]
            for _ in range(rounds):
                crossing = np.where(side[u] != side[v], 1, -1)
                gain = np.bincount(u, crossing, len(own)) + np.bincount(v, crossing, len(own))
                a, b = np.flatnonzero(~side), np.flatnonzero(side)
                a, b = a[np.argsort(-gain[a])], b[np.argsort(-gain[b])]
                n = min(len(a), len(b))
                better = np.flatnonzero(gain[a[:n]] + gain[b[:n]] > 0)
                n = len(better) // 3 + (len(better) > 0)
                if not n:
                    break
                side[a[better[:n]]], side[b[better[:n]]] = True, False
            label[own[side]] = part + step
    return label


@dataclass
class Router:
    """Softmax over parts of a vector's direction, and how many parts a query asks."""

    weight: np.ndarray
    bias: np.ndarray
    probes: int

    @staticmethod
    def directions(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.directions(x) @ self.weight + self.bias

    def ranked(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")

    @classmethod
    def fit(cls, x: np.ndarray, parts: int, recall: float = RECALL, steps: int = 300) -> Router:
        """x: the sample. A fifth of it only finds the number of parts to ask, by what the rest has nearest to it."""
        unit = cls.directions(x)
        held = np.arange(len(x)) % 5 == 4 if len(x) >= 50 else np.zeros(len(x), bool)
        train = unit[~held]
        parts = min(parts, max(1, len(train)))
        parts = 1 << (parts.bit_length() - 1)
        graph = neighbour_graph(train, NEIGHBOURS)
        label = balanced_parts(train, graph, parts)
        eye = np.eye(parts)
        target = 0.5 * eye[label] + 0.5 * (eye[label[graph]].mean(axis=1) if graph.shape[1] else eye[label])
        router = cls(np.zeros((x.shape[1], parts)), np.zeros(parts), parts)
        first, second = np.zeros_like(router.weight), np.zeros_like(router.weight)
        for t in range(1, steps + 1):  # Adam on the cross-entropy
            z = train @ router.weight + router.bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            slope = train.T @ (p - target) / len(train) + 1e-5 * router.weight
            first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
            router.weight = router.weight - 0.2 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
            router.bias = router.bias - 0.3 * (p - target).mean(axis=0)
        if held.any():
            place = router.logits(x[~held]).argmax(axis=1)
            order = np.argsort(router.ranked(x[held]), axis=1)
            k = min(20, len(train))
            near = np.argpartition(-(x[held] @ x[~held].T), k - 1, axis=1)[:, :k]
            needed = np.sort(np.take_along_axis(order, place[near], axis=1).ravel()) + 1
            router.probes = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))])
        return router


def _matrix(values: pa.Array) -> np.ndarray:
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1) if len(values) else np.zeros((0, 1))


def _route_batches(batches: Iterator[pa.RecordBatch], routers: dict[int, Router]) -> Iterator[pa.RecordBatch]:
    """Adds the ranked parts to ask; the first of them is where the row itself lies."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            part, router = batch.filter(pa.array(dims == dim)), routers[int(dim)]
            ranked = router.ranked(_matrix(part.column("embedding")))[:, : router.probes].astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in ("vec_id", "dim", "embedding")), pa.array(list(ranked), pa.list_(pa.int32()))], ["vec_id", "dim", "embedding", "parts"])


def _rerank(asked: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """Each query's k best rows of one block: query_id, vec_id, score."""
    q, x = _matrix(asked["embedding"]), _matrix(rows["embedding"])
    names, ids = asked["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
    out: list[list[np.ndarray]] = [[], [], []]
    order = np.argsort(ids, kind="stable")
    x, ids = x[order], ids[order]
    for lo in range(0, len(q) if len(ids) else 0, 256):
        score = q[lo : lo + 256] @ x.T
        score[names[lo : lo + 256][:, None] == ids[None, :]] = -np.inf
        least = np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(score), -np.inf)
        for i, row in enumerate(score):
            keep = np.flatnonzero((row >= least[i]) & (row > -np.inf))
            keep = keep[np.argsort(-row[keep], kind="stable")][:k]  # ids ascend, so ties keep the smaller
            out[0].append(np.full(len(keep), names[lo + i]))
            out[1].append(ids[keep])
            out[2].append(row[keep])
    return pa.table({n: pa.array(np.concatenate(v) if v else np.zeros(0), t) for n, v, t in zip(("query_id", "vec_id", "score"), out, (pa.int64(), pa.int64(), pa.float64()), strict=True)})


def searchable(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, embedding (doubles) of rows with an id whose vector is finite and not zero."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists(x, lambda v: v != 0)
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine).select(F.col("vec_id").cast("long"), F.size("embedding").alias("dim"), x.alias("embedding"))


def fit_routers(clean: DataFrame, sample: int = SAMPLE, recall: float = RECALL) -> dict[int, Router]:
    """A router for each dimension in use, each fitted on at most ``sample`` rows chosen by a hash of their id."""
    found = {}
    for r in clean.groupBy("dim").count().collect():
        rows = clean.where(F.col("dim") == r["dim"]).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toArrow()
        parts = min(MOST_PARTS, max(LEAST_PARTS, 1 << max(0, round(np.log2(r["count"] / PART_ROWS)))))
        found[r["dim"]] = Router.fit(_matrix(rows["embedding"]), parts, recall)
    return found


def nearest(vectors: DataFrame, queries, k: int = 20, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows of vectors (vec_id, embedding) that the condition ``queries`` selects.

    The k nearest found by inner product in double precision among rows with another vec_id and the
    same dimension, nearest first, ties to the smaller vec_id; fewer where there are fewer. Null or
    zero vectors, those with null or non-finite components and rows with a null vec_id take no part.
    A row that is repeated answers once for each repetition and is asked for once. Other columns are
    ignored; an empty table gives an empty result.
    """
    clean = searchable(vectors)
    routers = fit_routers(clean, sample, recall)
    kind = "vec_id long, dim int, embedding array<double>, parts array<int>"
    routed = written(clean.mapInArrow(partial(_route_batches, routers=routers), kind), "routed")
    rows = routed.select(*(F.col(n).alias(n) for n in ("vec_id", "dim", "embedding")), F.col("parts")[0].alias("part"))
    asked = routed.where(queries).dropDuplicates(["vec_id", "dim"]).withColumn("part", F.explode("parts")).drop("parts")
    # One row for each part: how many blocks and chunks it is cut into.
    blocks = rows.groupBy("dim", "part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    chunks = asked.groupBy("dim", "part").agg(F.ceil(F.count("*") / QUERY_CHUNK).cast("int").alias("chunks"))
    cut = F.broadcast(blocks.join(chunks, ["dim", "part"]))
    rows = rows.join(cut, ["dim", "part"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)"))).drop("blocks", "chunks")
    asked = asked.join(cut, ["dim", "part"]).withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("chunks")).cast("int")).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).drop("blocks", "chunks")
    key = ["dim", "part", "block", "chunk"]
    found = asked.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(lambda a, b: _rerank(a, b, k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 20 nearest of every row whose vec_id is divisible by 20, over the whole embeddings table."""
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
