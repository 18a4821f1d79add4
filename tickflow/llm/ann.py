"""Nearest neighbours by learned partitions.

1. A neighbour graph of a bounded sample of the vectors (``SAMPLE``, the smallest hashes of vec_id) is
   cut into balanced partitions: seeds grow by rounds in which every sample vector joins the partition
   that most of its graph neighbours are in, as long as that partition has room.
2. A small classifier (one hidden layer) learns from the vector which partitions hold its neighbours.
3. Every row of the table goes to its most probable partition; every query to its most probable ones,
   whose rows are compared with it exactly. How many those are is measured: a part of the sample is held
   out of graph and classifier, and the fewest partitions that hold ``RECALL`` of its true neighbours among
   the rest are probed. A query whose partitions hold too few rows for its k goes on to the next ones.

Partitions are unequal on real data, and one may hold a third of all rows: each is stored in blocks of
about ``BLOCK`` rows, queries meet it block by block, and the best of each block are merged. Nothing in
a partition is skipped. A block of rows is copied once for each ``QUERY_BLOCK`` queries that probe its
partition, and within the task they meet ``TILE`` queries at a time.

Nearness is the largest inner product, in double precision on the stored vectors. The graph and the
classifier work on unit vectors with the norm as one more coordinate, so lengths count as well.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no
part, neither as query nor as candidate; vectors of another length than the most frequent one neither;
ties go to the smaller vec_id; different vectors under one vec_id are rows of their own (each may be found,
also by another one of its vec_id, and each that asks is answered under that vec_id), equal ones under
one vec_id count as one; null vec_ids take no part; with at most k candidates all are returned; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickflow.llm.common import map_in_arrow, read_table, shared_table

SAMPLE = 6_000
PARTITIONS = 32
RECALL = 0.94
NEIGHBOURS = 10
BLOCK = 8_192
QUERY_BLOCK = 16_384
TILE = 256
HIDDEN = 64
#: A partition of the sample may hold so many times its equal share.
ROOM = 1.1


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors that take part, as doubles."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).alias("vec_id"), v.alias("v")).filter(
        "vec_id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)")
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (common["n"] if common else 0))


def lifted(x: np.ndarray, scale: float) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.hstack((x / np.maximum(norm, 1e-300), norm / scale))


def neighbour_graph(x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """The k nearest sample vectors of each, by inner product, in blocks."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), max(k, 0)), np.int64)
    for a in range(0, len(x) if k > 0 else 0, 1024):
        s = x[a:a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a:a + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_partition(graph: np.ndarray, x: np.ndarray, parts: int, rng: np.random.Generator, rounds: int = 20) -> np.ndarray:
    """Partition of the graph's nodes with at most ROOM times the equal share in each, few edges cut.

    Starts from balanced assignment to centres and then moves nodes to the partition of most neighbours.
    """
    n = len(x)
    room = int(np.ceil(ROOM * n / parts))
    centres = x[rng.choice(n, parts, replace=n < parts)]
    part = np.zeros(n, np.int64)
    for _ in range(8):
        score = x @ centres.T
        order = np.argsort(-(np.sort(score, axis=1)[:, -1] - np.median(score, axis=1)), kind="stable")
        held = np.zeros(parts, np.int64)
        for i in order:
            for p in np.argsort(-score[i], kind="stable"):
                if held[p] < room:
                    part[i] = p
                    held[p] += 1
                    break
        centres = np.stack([x[part == p].mean(axis=0) if held[p] else centres[p] for p in range(parts)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    back = [[] for _ in range(n)]
    for i, js in enumerate(graph):
        for j in js:
            back[j].append(i)
    for _ in range(rounds):
        moved = 0
        for i in rng.permutation(n):
            near = np.concatenate((graph[i], np.asarray(back[i], np.int64)))
            votes = np.bincount(part[near], minlength=parts)
            best = int(np.argmax(votes))
            if best != part[i] and votes[best] > votes[part[i]] and held[best] < room:
                held[part[i]] -= 1
                held[best] += 1
                part[i] = best
                moved += 1
        if not moved:
            break
    return part


def shares(part: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Share of each partition among a node and its graph neighbours."""
    near = np.column_stack((np.arange(len(part)), graph))
    return np.eye(parts)[part[near]].mean(axis=1)


class Router:
    """Classifier with one hidden layer: the share of a vector's neighbours that each partition holds."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, epochs: int = 30):
        self.a, self.ab = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN)
        self.b, self.bb = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, y.shape[1])), np.zeros(y.shape[1])
        weights = [self.a, self.ab, self.b, self.bb]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
                h = np.maximum(x[rows] @ self.a + self.ab, 0)
                p = self._soft(h @ self.b + self.bb)
                p = (p - y[rows]) / len(rows)
                back = (p @ self.b.T) * (h > 0)
                step += 1
                for w, g, m, s in zip(weights, (x[rows].T @ back, back.sum(0), h.T @ p, p.sum(0)), first, second):
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    w -= 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)

    @staticmethod
    def _soft(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def order(self, x: np.ndarray) -> np.ndarray:
        """Partitions from the most probable to the least."""
        return np.argsort(-(np.maximum(x @ self.a + self.ab, 0) @ self.b + self.bb), axis=1, kind="stable")


#: One of so many sample vectors is held out to measure how many partitions to probe.
HELD_OUT = 6


def probes_needed(router: Router, scale: float, base: np.ndarray, asked: np.ndarray, k: int, recall: float, parts: int) -> int:
    """The fewest partitions of each asked vector that hold ``recall`` of its k nearest of ``base``."""
    if not len(base) or not len(asked):
        return parts
    home = router.order(lifted(base, scale))[:, 0]
    place = np.argsort(router.order(lifted(asked, scale)), axis=1)  # place[i, p]: when i probes p
    k = min(k, len(base))
    near = np.argpartition(-(asked @ base.T), k - 1, axis=1)[:, :k]
    when = np.sort(np.take_along_axis(place, home[near], axis=1).ravel())
    return int(when[int(np.ceil(recall * len(when))) - 1]) + 1


def fit_router(vectors: DataFrame, parts: int = PARTITIONS, sample: int = SAMPLE, seed: int = 5, recall: float = RECALL, k: int = 20) -> tuple[Router, float, int] | None:
    """Classifier, length scale and partitions to probe, from a bounded sample of the usable vectors."""
    got = vectors.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id", "v").limit(sample).toPandas()
    if not len(got):
        return None
    rng = np.random.default_rng(seed)
    raw = np.array(got["v"].tolist(), float)
    scale = float(np.linalg.norm(raw, axis=1).max())
    held = np.arange(len(raw)) % HELD_OUT == HELD_OUT - 1
    base, asked = raw[~held], raw[held]
    x = lifted(base, scale)
    graph = neighbour_graph(base)
    router = Router(x, shares(balanced_partition(graph, x, parts, rng), graph, parts), rng)
    return router, scale, probes_needed(router, scale, base, asked, k, recall, parts)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, parts: int = PARTITIONS, probes: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row, never the query's own row.

    ``vectors``, ``queries``: (vec_id, v) as ``usable`` gives them. ``probes``: partitions to probe, measured if None.
    """
    spark = vectors.sparkSession
    fitted = fit_router(vectors, parts, k=k)
    if fitted is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    router, scale, measured = fitted
    sent = spark.sparkContext.broadcast((router, scale))  # a few thousand numbers

    rows = vectors.select("vec_id", "v").distinct()
    asked = queries.select("vec_id", "v").distinct().withColumn("asked", F.monotonically_increasing_id())

    def route(names: list[str], count: int, room: np.ndarray | None = None):
        """Adds ``parts``: the first ``count`` partitions, and more until they have room for k rows and the query's own."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            router, scale = sent.value
            for b in batches:
                found = []
                if b.num_rows:
                    order = router.order(lifted(np.array(b.column("v").to_pylist(), float).reshape(b.num_rows, -1), scale))
                    stop = np.full(len(order), count)
                    if room is not None:
                        stop = np.maximum(stop, (np.cumsum(room[order], axis=1) < k + 1).sum(axis=1) + 1)
                    found = [o[:n] for o, n in zip(order.tolist(), stop.tolist())]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.list_(pa.int32()))], names=[*names, "parts"])
        return run

    index = shared_table(map_in_arrow(rows, route(["vec_id", "v"], 1), "vec_id bigint, v array<double>, parts array<int>")
                         .select("vec_id", "v", F.col("parts")[0].alias("part")), "index")
    held = index.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    room = np.zeros(parts, np.int64)
    for r in held.collect():  # one row per partition
        room[r["part"]] = r["rows"]
    names = ["vec_id", "v", "asked"]
    probe = shared_table(map_in_arrow(asked, route(names, min(parts, probes or measured), room), "vec_id bigint, v array<double>, asked bigint, parts array<int>")
                         .select(*names, F.explode("parts").alias("part")), "probes")

    def blocks(n: DataFrame, size: int, name: str) -> DataFrame:
        return n.select("part", F.ceil(F.col("rows") / size).cast("int").alias(name))

    n = blocks(held, BLOCK, "nb").join(blocks(probe.groupBy("part").agg(F.count(F.lit(1)).alias("rows")), QUERY_BLOCK, "nq"), "part")  # one row per partition
    left = (index.join(F.broadcast(n), "part").withColumn("b", F.pmod(F.xxhash64(F.lit(1), "vec_id", "v"), "nb").cast("int"))
            .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("nq") - 1))).select("part", "b", "q", "vec_id", "v"))
    right = (probe.join(F.broadcast(n), "part").withColumn("q", F.pmod(F.xxhash64(F.lit(2), "asked"), "nq").cast("int"))
             .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select("part", "b", "q", "asked", "vec_id", "v"))

    def nearest(base: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        kinds = {"asked": np.int64, "query_id": np.int64, "vec_id": np.int64, "score": float}
        out = [pd.DataFrame({c: np.empty(0, t) for c, t in kinds.items()})]
        if len(base) and len(query):
            x, q = np.array(base["v"].tolist(), float), np.array(query["v"].tolist(), float)
            ids = base["vec_id"].to_numpy()
            wanted = min(k + 1, len(ids))
            # twice as far may a sum in another order lie from ours
            slack = 2.3e-16 * (x.shape[1] + 8) * np.linalg.norm(x, axis=1).max() * np.linalg.norm(q, axis=1)
            for a in range(0, len(q), TILE):
                rough = q[a:a + TILE] @ x.T
                for row, asked, own in zip(range(a, a + len(rough)), query["asked"].to_numpy()[a:a + TILE], query["vec_id"].to_numpy()[a:a + TILE]):
                    s = rough[row - a]
                    least = np.partition(s, len(s) - wanted)[len(s) - wanted]
                    # all that may be among the k and the own row after summing in one fixed order
                    near = np.flatnonzero(s >= least - slack[row])
                    near = near[(ids[near] != own) | (x[near] != q[row]).any(axis=1)]
                    exact = np.add.reduce(x[near] * q[row], axis=1)
                    best = np.lexsort((ids[near], -exact))[:k]
                    out.append(pd.DataFrame({"asked": asked, "query_id": own, "vec_id": ids[near][best], "score": exact[best]}))
        return pd.concat(out)

    best = left.groupBy("part", "b", "q").cogroup(right.groupBy("part", "b", "q")).applyInPandas(nearest, "asked bigint, query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")).cast("int")
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = usable(read_table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.filter("vec_id % 20 = 0"), 20)
