"""Embedding near-dedup (13): spherical k-means cells, blocked cosine products, one
representative of each group.

Equal vectors of a label are one class. Classes are assigned to the cell of their nearest
centroid by cosine. A class that lies so near to the border of a lower-numbered cell that a
partner could be on its other side visits that cell, so every linked pair meets in
exactly one cell and none is lost. A cell's rows are dealt into tiles of bounded size; tile
against tile is one matrix product. Links are counted where they are found, and only
a spanning forest of each product goes on to the components: a dense group never
becomes a list of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, ship_package, staged
from tessera.llm.components import connected_components

#: Classes of a tile, rows a task assigns at a time, classes sampled for each
#: centroid, rounds of k-means. They decide the cost, not the result.
TILE, ROWS, SAMPLED, ROUNDS = 2_048, 4_096, 64, 5
#: Allowance for rounding at the border of a cell.
SLACK = 1e-9


def takes_part(vec: Column) -> Column:
    """Not null, nor empty, nor zero, without null or non-finite components."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def unit_rows(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision; scaled first, so
    that no square overflows."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _row_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def fit_cells(classes: DataFrame, dim: int, total: int, cells: int | None = None) -> np.ndarray:
    """Unit centroids of about ``sqrt(total) / 8`` cells, fitted by spherical k-means on
    ``SAMPLED`` classes for each. Assignment and sums run in tasks; the driver sees the
    centroids only, whose number grows with the root of the classes'."""
    spark = classes.sparkSession
    wanted = cells or max(1, math.ceil(math.sqrt(total) / 8))
    share = min(1.0, 2.0 * SAMPLED * wanted / max(1, total))
    drawn = classes.filter(F.pmod(F.xxhash64("cls"), F.lit(1 << 30)) < int(share * (1 << 30))).select("cls", "vec")
    drawn = staged(drawn, "neardup-sample")
    first = drawn.orderBy(F.xxhash64("cls", F.lit(1)), "cls").limit(wanted).select("vec").toArrow().column(0).combine_chunks()
    if not len(first):
        return np.zeros((0, dim))
    centroids = unit_rows(first)
    for _ in range(ROUNDS if len(centroids) > 1 else 0):
        shared = spark.sparkContext.broadcast(centroids)

        def sums(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            c = shared.value
            total = np.zeros_like(c)
            for b in _row_parts(batches):
                x = unit_rows(b.column(0))
                np.add.at(total, (x @ c.T).argmax(axis=1), x)
            used = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used].tolist(), pa.list_(pa.float64()))],
                                             names=["cell", "total"])

        def add(t: pa.Table) -> pa.Table:
            x = np.asarray(t.column("total").to_pylist()).sum(axis=0)
            return pa.table({"cell": t.column("cell").slice(0, 1), "total": pa.array([x.tolist()], pa.list_(pa.float64()))})

        parts = drawn.select("vec").mapInArrow(sums, "cell int, total array<double>")
        for r in parts.groupBy("cell").applyInArrow(add, "cell int, total array<double>").collect():  # a row per cell
            x = np.asarray(r["total"])
            if x.any():
                centroids[r["cell"]] = x / np.sqrt((x * x).sum())
        shared.unpersist()
    return centroids


def _assigned(classes: DataFrame, shared, dim: int, threshold: float, vectors: bool) -> DataFrame:
    """``(label, dim, cell, visits, cls)``, with ``n`` and ``vec`` where ``vectors`` are wanted: each
    class in its home cell and as visitor of the lower-numbered cells a partner may be in.
    Vectors of other lengths than ``dim`` are one cell for each length."""
    spread = math.sqrt(1 - threshold * threshold) + SLACK
    cols = ["label", "dim", "cls", *(["n"] if vectors else [])]
    kept = classes.select(*cols, "vec")
    types = {f.name: f.dataType.simpleString() for f in kept.schema}
    out = [*cols, "cell", "visits", *(["vec"] if vectors else [])]
    types |= {"cell": "int", "visits": "boolean"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        apart = np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T)))
        for b in _row_parts(batches):
            vec = b.column(len(cols))
            score = unit_rows(vec) @ c.T
            home = score.argmax(axis=1)
            gap = score[np.arange(len(home)), home][:, None] - score
            visits = (gap <= spread * apart[home]) & (np.arange(len(c)) < home[:, None])
            row, cell = np.nonzero(visits)
            for at, cells, visitor in ((np.arange(len(home)), home, False), (row, cell, True)):
                for s in range(0, len(at), ROWS):
                    part, at_cell = pa.array(at[s:s + ROWS]), cells[s:s + ROWS]
                    values = [b.column(k).take(part) for k in range(len(cols))]
                    values += [pa.array(at_cell, pa.int32()), pa.array([visitor] * len(part), pa.bool_())]
                    yield pa.RecordBatch.from_arrays(values + ([vec.take(part)] if vectors else []), names=out)

    same = kept.filter(F.col("dim") == dim).mapInArrow(run, ", ".join(f"{c} {types[c]}" for c in out))
    other = kept.filter(F.col("dim") != dim).withColumn("cell", F.lit(-1)).withColumn("visits", F.lit(False)).select(*out)
    return same.unionByName(other)


def _forest(u: np.ndarray, v: np.ndarray, nodes: int) -> np.ndarray:
    """The smallest node reachable from each over the links ``(u, v)``."""
    low = np.arange(nodes)
    while True:
        least = np.minimum(low[u], low[v])
        np.minimum.at(low, u, least)
        np.minimum.at(low, v, least)
        low = low[low]
        if (low[u] == low[v]).all():
            return low


def _tile_links(t: pa.Table, threshold: float) -> pa.Table:
    """Links of one pair of tiles: ``(u, null, links)`` counts and ``(u, v, 0)`` forest edges."""
    tile = t.column("tile").to_numpy()
    left = np.flatnonzero(tile == tile.min())
    right = np.flatnonzero(tile == tile.max()) if t.column("j")[0] != t.column("i")[0] else left
    if not len(left) or not len(right) or (t.column("j")[0] != t.column("i")[0] and tile.min() == tile.max()):
        return _link_table([], [], [])
    x = unit_rows(t.column("vec").combine_chunks())
    cls, n = t.column("cls").to_numpy(), t.column("n").to_numpy()
    near = x[left] @ x[right].T >= threshold
    if right is left:
        near &= ~np.eye(len(left), dtype=bool)
    if not near.any():
        return _link_table([], [], [])
    links = np.zeros(len(cls), np.int64)
    links[left] += (near * n[right]).sum(axis=1)
    if right is not left:
        links[right] += (near * n[left][:, None]).sum(axis=0)
    r, c = np.nonzero(np.triu(near) if right is left else near)
    low = _forest(left[r], right[c], len(cls))
    counted, moved = np.flatnonzero(links), np.flatnonzero(low != np.arange(len(cls)))
    return _link_table([*cls[counted], *cls[moved]], [*[None] * len(counted), *cls[low[moved]]], [*links[counted], *[0] * len(moved)])


def _link_table(u, v, n) -> pa.Table:
    return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(n, pa.int64())], names=["u", "v", "n"])


def _links(classes: DataFrame, shared, dim: int, threshold: float) -> DataFrame:
    spaces = ["label", "dim", "cell"]
    sizes = _assigned(classes, shared, dim, threshold, False).groupBy(*spaces).agg(
        F.ceil(F.count_if(~F.col("visits")) / TILE).cast("int").alias("homes"),
        F.ceil(F.count_if("visits") / TILE).cast("int").alias("guests")).filter("homes > 0")
    rows = _assigned(classes, shared, dim, threshold, True).join(broadcast_if_small(staged(sizes, "neardup-sizes")), spaces)
    deal = lambda n: F.pmod(F.xxhash64("cls"), n).cast("int")
    rows = rows.withColumn("tile", F.when(F.col("visits"), F.col("homes") + deal(F.col("guests"))).otherwise(deal(F.col("homes"))))
    meets = F.when(F.col("visits"), F.col("homes")).otherwise(F.col("homes") + F.col("guests"))
    rows = rows.withColumn("_u", F.explode(F.sequence(F.lit(0), meets - 1)))
    rows = rows.select(*spaces, F.least("tile", "_u").alias("i"), F.greatest("tile", "_u").alias("j"), "tile", "cls", "n", "vec")
    return rows.groupBy(*spaces, "i", "j").applyInArrow(lambda t: _tile_links(t, threshold), "u bigint, v bigint, n bigint")


def near_duplicates(df: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", cells: int | None = None) -> DataFrame:
    """``(id_col, n_links, component_id, kept)``, one row for each row of ``df``: the number
    of other rows of the same label with a cosine of ``threshold`` (over 0, at most 1) or
    more, the smallest id reachable by such links (its own included), and whether that is
    the row's own id.

    Cosines are taken in double precision. Rows whose label is null, and vectors that are
    null, empty, zero or hold null or non-finite components link with nothing, nor do
    vectors of different length. Repeated rows and ids are rows of their own (equal
    vectors link). A null id links like others but names no component; a group of null ids
    alone has component null and all of it is kept. An empty table gives no rows; other
    columns are not read. ``cells`` sets the number of cells; it does not change the result."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be over 0 and at most 1")
    spark = df.sparkSession
    ship_package(spark)
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    ok = F.col("label").isNotNull() & takes_part(F.col("vec"))
    classes = rows.filter(ok).groupBy("label", "vec").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    classes = staged(classes.withColumn("cls", F.monotonically_increasing_id()).withColumn("dim", F.size("vec")), "neardup-classes")
    lengths = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    dim, total = lengths or (1, 0)
    shared = spark.sparkContext.broadcast(fit_cells(classes.filter(F.col("dim") == dim), dim, total, cells))
    links = staged(_links(classes, shared, dim, threshold), "neardup-links")
    counts = links.filter("v IS NULL").groupBy(F.col("u").alias("cls")).agg(F.sum("n").alias("others"))
    joined = connected_components(links.filter("v IS NOT NULL"), "u", "v").withColumnRenamed("node", "cls")
    joined = staged(joined.join(classes.select("cls", "first"), "cls"), "neardup-joined")
    lowest = staged(joined.groupBy("component").agg(F.min("first").alias("lowest")), "neardup-lowest")
    found = (classes.join(counts, "cls", "left").join(joined.select("cls", "component"), "cls", "left")
             .join(broadcast_if_small(lowest), "component", "left"))
    found = found.select("label", "vec", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                         F.when(F.col("component").isNull(), F.col("first")).otherwise(F.col("lowest")).alias("component_id"))
    out = rows.filter(ok).join(found, ["label", "vec"]).select("id", "n_links", "component_id")
    alone = rows.filter(~ok).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id",
                                         F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
