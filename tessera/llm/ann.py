"""Approximate nearest neighbours (2): balanced posting lists.

Centroids are fitted on a bounded sample by repeated balanced halving. Every vector
goes into the list of its nearest centroid, and vectors near a boundary into a few more
(replicas). A query finds its nearest centroids in an in-memory neighbour graph and
reads the lists whose centroid is not much farther than the nearest one (distance-ratio
pruning). Lists longer than a bound are split into shards, and the queries of a list into
blocks, so that no list is one task.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, ship_package, staged

#: The fit reads at most this many vectors (those of the smallest id hash).
SAMPLE = 20_000
#: Vectors a list is meant to hold, most centroids, and rows of a list's shard.
LIST_SIZE, MAX_CENTROIDS, SHARD = 200, 4_000, 4_000
#: Queries that one task holds of a list's shard.
QUERY_BLOCK = 4_000
#: A vector is replicated to centroids up to this ratio of its nearest distance.
REPLICA_RATIO, REPLICAS = 1.15, 4
#: A query reads lists up to this ratio of its nearest centroid's distance, at most
#: ``PROBES`` whatever the number of lists (recall by size: README). The graph search holds
#: that share more centroids than it returns.
QUERY_RATIO, PROBES, BEAM = 1.8, 160, 1.25
GRAPH_DEGREE = 24
#: Vectors that are placed at a time.
ROWS = 2_048


def balanced_centroids(sample: np.ndarray, size: int, seed: int = 7) -> np.ndarray:
    """Centroids of groups of about ``size``: each group is halved at the median of the
    difference of the distances to two centres (2-means), until small enough."""
    rng = np.random.default_rng(seed)
    todo, out = [np.arange(len(sample))], []
    while todo:
        at = todo.pop()
        x = sample[at]
        if len(at) <= size or np.all(x == x[0]):
            out.append(x.mean(axis=0))
            continue
        c = x[rng.choice(len(x), 2, replace=False)]
        for _ in range(6):
            side = ((x - c[0]) ** 2).sum(1) - ((x - c[1]) ** 2).sum(1)
            half = np.zeros(len(x), bool)
            half[np.argsort(side, kind="stable")[:len(x) // 2]] = True
            c = np.stack([x[half].mean(axis=0), x[~half].mean(axis=0)])
        todo += [at[half], at[~half]]
    return np.unique(np.asarray(out), axis=0)


class CentroidGraph:
    """Neighbour graph over the centroids; searched greedily with a beam."""

    def __init__(self, centroids: np.ndarray, degree: int = GRAPH_DEGREE):
        self.centroids = centroids
        n = len(centroids)
        near = [np.argsort(((centroids - c) ** 2).sum(1), kind="stable")[1:degree + 1] for c in centroids]
        links: list[set[int]] = [set(map(int, a)) for a in near]
        for i, a in enumerate(near):
            for j in a:
                links[j].add(i)
        hub = int(np.argmin(((centroids - centroids.mean(axis=0)) ** 2).sum(1))) if n else 0
        # a spread of entry points keeps every part of the graph in reach
        self.entries = sorted({hub, *range(0, n, max(1, math.isqrt(n)))})
        self.links = [np.array(sorted(s), dtype=np.int64) for s in links]

    def place(self, x: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``count`` nearest centroids of each row of ``x`` and their distances, nearest
        first: one matrix product for all rows (few are wanted of each, and the products
        are cheaper than walks)."""
        c = self.centroids
        count = min(count, len(c))
        square = (x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * (x @ c.T)
        at = np.argpartition(square, count - 1, axis=1)[:, :count]
        d = np.sqrt(((x[:, None, :] - c[at]) ** 2).sum(-1))
        order = np.lexsort((at, d), axis=1)
        return np.take_along_axis(at, order, 1), np.take_along_axis(d, order, 1)

    def search(self, q: np.ndarray, count: int, beam: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """About the ``count`` nearest centroids of ``q`` and their distances, nearest first,
        by a walk through the graph; exactly these if the beam would hold all centroids."""
        beam = max(beam, math.ceil(BEAM * count))
        if beam >= len(self.centroids):
            at, d = self.place(q[None, :], count)
            return at[0], d[0]
        start = np.array(self.entries)
        d = np.sqrt(((self.centroids[start] - q) ** 2).sum(1))
        seen = set(self.entries)
        open_ = [(float(x), int(i)) for x, i in zip(d, start, strict=True)]
        best = sorted(open_)[:beam]
        heapq.heapify(open_)
        while open_:
            dist, i = heapq.heappop(open_)
            if len(best) >= beam and dist > best[-1][0]:
                break
            new = np.array([j for j in self.links[i] if j not in seen], dtype=np.int64)
            if not len(new):
                continue
            seen.update(map(int, new))
            dn = np.sqrt(((self.centroids[new] - q) ** 2).sum(1))
            found = [(float(x), int(j)) for x, j in zip(dn, new, strict=True)]
            for item in found:
                heapq.heappush(open_, item)
            best = sorted(best + found)[:beam]
        top = best[:count]
        return np.array([j for _, j in top], dtype=np.int64), np.array([x for x, _ in top])


def clean_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, vec)`` in double precision of the rows that take part: id not null, vector
    neither null, empty nor zero, without null or non-finite components."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.select(F.col(id_col).cast("long").alias("id"), v.alias("vec")).filter(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0))


def fit_centroids(vectors: DataFrame, sample: int = SAMPLE, list_size: int = LIST_SIZE) -> CentroidGraph:
    """Fit on at most ``sample`` distinct vectors. The group size follows the whole
    table's count, so that lists hold about ``list_size`` vectors (until
    ``MAX_CENTROIDS`` is reached)."""
    total = vectors.count()
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("vec").toArrow().column(0)
    x = np.unique(_matrix(rows), axis=0) if total else np.zeros((0, 1))
    wanted = min(MAX_CENTROIDS, max(1, total // list_size))
    return CentroidGraph(balanced_centroids(x, max(2, math.ceil(len(x) / wanted))) if len(x) else x)


def _postings(vectors: DataFrame, shared) -> DataFrame:
    """``(list, row, id, vec)``: every vector in the lists of its nearest centroids, at most
    ``REPLICAS``, within the ratio of the nearest one's distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = shared.value
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            at, d = graph.place(_matrix(b.column(2)), REPLICAS)
            row, k = np.nonzero(d <= REPLICA_RATIO * d[:, :1] + 1e-12)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(at[row, k], pa.int32()), *[c.take(take) for c in b.columns]],
                                             names=["list", "row", "id", "vec"])

    return vectors.select("row", "id", "vec").mapInArrow(run, "list int, row bigint, id bigint, vec array<double>")


def _probed(asked: DataFrame, shared, ratio: float, most: int) -> DataFrame:
    """``(list, q, qid, qv)``: the lists each query reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = shared.value
        for b in batches:
            rows, lists = [], []
            for k, v in enumerate(_matrix(b.column(2))):
                at, d = graph.search(v, most)
                near = at[d <= ratio * d[0] + 1e-12].tolist()
                lists += near
                rows += [k] * len(near)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), *[c.take(take) for c in b.columns]],
                                             names=["list", "q", "qid", "qv"])

    return asked.select("row", "id", "vec").mapInArrow(run, "list int, q bigint, qid bigint, qv array<double>")


def search(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           ratio: float = QUERY_RATIO, probes: int = PROBES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``queries`` the ``k`` nearest
    rows of ``df`` found, its own row left out (one row of its id and vector, where there
    is one); Euclidean distance in double precision, ties to the smaller id. Vectors that
    are null, zero, or hold null or non-finite components take no part, nor do null ids,
    nor vectors of another length than the most frequent one (the shorter on ties).
    Every row is indexed; a query of which the lists read hold fewer than ``k`` others
    is answered from all rows. Rows that repeat an id, a vector or both are rows of their
    own, as candidates and as queries (their answers stand under one ``query_id``). At most
    ``probes`` lists are read for a query, found by a walk through the graph."""
    spark = df.sparkSession
    ship_package(spark)
    vectors = staged(clean_vectors(df, id_col, vec_col).withColumn("row", F.monotonically_increasing_id()), "ann-rows")
    lengths = vectors.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = lengths["dim"] if lengths else 0
    vectors = vectors.filter(F.size("vec") == dim)
    asked = clean_vectors(queries, id_col, vec_col).filter(F.size("vec") == dim)
    asked = staged(asked.withColumn("row", F.monotonically_increasing_id()), "ann-asked")
    shared = spark.sparkContext.broadcast(fit_centroids(vectors))  # at most MAX_CENTROIDS centroids
    postings = staged(_postings(vectors, shared), "ann-postings")
    probed = staged(_probed(asked, shared, ratio, probes), "ann-probed")
    # long lists (copies, dense places) are dealt into shards, their queries into blocks of bounded size
    shards = postings.groupBy("list").agg(F.ceil(F.count("row") / SHARD).cast("int").alias("shards"))
    blocks = probed.groupBy("list").agg(F.ceil(F.count("q") / QUERY_BLOCK).cast("int").alias("blocks"))
    read = F.broadcast(staged(shards.join(blocks, "list"), "ann-read"))  # at most MAX_CENTROIDS rows
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    postings = postings.join(read, "list").select("list", deal("row", "shards").alias("shard"), each("blocks").alias("block"), "row", "id", "vec")
    probed = probed.join(read, "list").select("list", each("shards").alias("shard"), deal("q", "blocks").alias("block"), "q", "qid", "qv")
    lists = postings.groupBy("list", "shard", "block")
    found = lists.cogroup(probed.groupBy("list", "shard", "block")).applyInArrow(
        lambda p, q: _nearest(p, q, k), "q bigint, qid bigint, row bigint, id bigint, score double")
    found = staged(_others(found), "ann-found")
    few = asked.join(found.groupBy(F.col("q").alias("row")).agg(F.count("id").alias("n")), "row", "left").filter(F.coalesce("n", F.lit(0)) < k)
    few = staged(few.select("row", "id", "vec"), "ann-few")
    if few.limit(1).count():
        answered = found.join(broadcast_if_small(few.select(F.col("row").alias("q"))), "q", "left_anti")
        found = answered.unionByName(_others(_from_all(vectors, few, k)))
    # row_number <= k is cut down to k rows of a query in every task before the shuffle
    rank = F.row_number().over(Window.partitionBy("q").orderBy("score", "id", "row"))
    best = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.select(F.col("qid").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def _others(found: DataFrame) -> DataFrame:
    """Each row found for a query once (replicas give it again), without the query's own: the
    first of those of its id and vector. Every task kept one row more than wanted for that."""
    once = found.dropDuplicates(["q", "row"]).withColumn("own", (F.col("id") == F.col("qid")) & (F.col("score") == 0))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("own"), "row"))
    return once.withColumn("place", place).filter(~(F.col("own") & (F.col("place") == 1))).drop("own", "place")


_FOUND = ("q", "qid", "row", "id")


def _best_of(p: dict, x: np.ndarray, asked: dict, q: np.ndarray, k: int) -> pa.Table:
    """The ``k + 1`` nearest rows of each query among ``p`` (rows and ids of ``x``), exactly, by
    (score, id, row)."""
    out: dict[str, list] = {c: [] for c in (*_FOUND, "score")}
    for own, own_id, v in zip(asked["q"].tolist(), asked["qid"].tolist(), q, strict=True):
        d = np.sqrt(((x - v) ** 2).sum(1))
        rows, ids = p["row"], p["id"]
        if len(d) > 4 * (k + 1):
            near = d <= np.partition(d, k)[k]
            d, rows, ids = d[near], rows[near], ids[near]
        top = np.lexsort((rows, ids, d))[:k + 1]
        out["q"] += [own] * len(top)
        out["qid"] += [own_id] * len(top)
        out["row"] += rows[top].tolist()
        out["id"] += ids[top].tolist()
        out["score"] += d[top].tolist()
    return pa.table([*[pa.array(out[c], pa.int64()) for c in _FOUND], pa.array(out["score"], pa.float64())], names=list(out))


def _matrix(column) -> np.ndarray:
    """Vectors of one length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _nearest(p: pa.Table, q: pa.Table, k: int) -> pa.Table:
    if not p.num_rows:
        q = q.slice(0, 0)
    columns = lambda t, names: {c: t.column(c).to_numpy() for c in names}
    return _best_of(columns(p, ("row", "id")), _matrix(p.column("vec")), columns(q, ("q", "qid")), _matrix(q.column("qv")), k)


def _from_all(vectors: DataFrame, few: DataFrame, k: int) -> DataFrame:
    """Exact answers for queries that the lists left short: all rows stream past blocks
    of queries, and each task keeps the best of its batch."""
    per_block = 200
    few = few.select(F.col("row").alias("q"), F.col("id").alias("qid"), F.col("vec").alias("qv"))
    blocks = few.repartitionByRange("q").withColumn("block", F.floor(F.monotonically_increasing_id() / per_block))
    blocks = blocks.groupBy("block").agg(F.collect_list(F.struct("q", "qid", "qv")).alias("asked"))
    parts = max(1, vectors.count() // 1_000)
    chunks = vectors.groupBy(F.pmod(F.xxhash64("row"), F.lit(parts)).alias("chunk")).agg(
        F.collect_list(F.struct("row", "id", "vec")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for asked, held in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                columns = lambda rows, names: {c: np.asarray([r[c] for r in rows], np.int64) for c in names}
                vecs = lambda rows, c: np.asarray([r[c] for r in rows], np.float64)
                t = _best_of(columns(held, ("row", "id")), vecs(held, "vec"), columns(asked, ("q", "qid")), vecs(asked, "qv"), k)
                yield from t.to_batches()

    paired = broadcast_if_small(staged(blocks, "ann-blocks"), 100).join(staged(chunks, "ann-chunks").select("rows"))
    return paired.select("asked", "rows").mapInArrow(run, "q bigint, qid bigint, row bigint, id bigint, score double")
