"""Skew-safe plans for ordered series (per-key or keyless).

A plain ``Window.partitionBy(key).orderBy(ts)`` puts every row of a key in one
task, and a keyless ``Window.orderBy(ts)`` puts the whole table in one task
(``Exchange SinglePartition``). Here no group spans a whole key:

1. :func:`with_position` sorts the rows by (keys, order) into ranges drawn from
   the data, so a hot key, a dense hour or many rows of one time are split like
   any others. The sorted rows are written once to the shared checkpoint folder
   with their place in their range; the position in the series is the number of
   rows in earlier ranges plus that place, less the series' first. The written
   rows make every later step see one order, also after an executor loss.
2. Frames of ``w`` rows (:func:`rolling`, :func:`lag`) run on
   ``(key, pos div chunk_rows)`` groups; the last ``w-1`` rows of each chunk are
   copied into the next chunk as a halo and dropped after the window.
   Frames of a time span (:func:`rolling_time`) use the same chunks with a halo by time.
3. Running totals (:func:`running_sum`) are chunk-local running sums plus the
   prefix of earlier chunk totals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.time import epoch_us
from tessera.session import broadcast_if_small, staged

SK = "_sk"          # struct of the series keys; struct equality is null-safe
POS = "_pos"        # dense 0-based position within the series
DEFAULT_CHUNK_ROWS = 1 << 20


def series_key(keys: Sequence[str]) -> Column:
    if keys:
        return F.struct(*[F.col(k) for k in keys])
    return F.struct(F.lit(0).alias("_all"))


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], from_zero: bool = True) -> DataFrame:
    """Add ``_sk`` (series key struct) and ``_pos`` (exact dense position in the
    series by ``order``, missing values last; make ``order`` unique within a key for
    determinism). No row is lost. The rows are sorted and staged here (a job runs). Without
    ``from_zero`` positions run on from series to series, which spares the look-up of
    each series' first row; frames, changes and running sums need no more."""
    base = df.withColumn(SK, series_key(keys))
    by = [F.col(c).asc_nulls_last() for c in [*keys, *order]]
    ranged = base.repartitionByRange(*by).sortWithinPartitions(*by)
    # (partition << 33) + row in the partition
    ranged = staged(ranged.withColumn(POS, F.monotonically_increasing_id()), "positions")
    part = F.shiftright(POS, 33)
    # one row for each range: bounded by the number of partitions
    sizes = sorted(ranged.groupBy(part.alias("p")).count().collect(), key=lambda r: r["p"])
    offsets, total = [], 0
    for r in sizes:
        offsets.append((r["p"], total - (r["p"] << 33)))
        total += r["count"]
    shift = F.broadcast(df.sparkSession.createDataFrame(offsets, "_part bigint, _shift bigint"))
    rank = ranged.join(shift, part == F.col("_part")).withColumn(POS, F.col(POS) + F.col("_shift")).drop("_part", "_shift")
    if not keys or not from_zero:
        return rank
    first = ranged.groupBy(SK).agg(F.min(POS).alias("_first"))
    first = first.join(shift, F.shiftright("_first", 33) == F.col("_part")).select(
        F.col(SK).alias("_series"), (F.col("_first") + F.col("_shift")).alias("_start"))
    return (rank.join(broadcast_if_small(first), F.col(SK) == F.col("_series"))
            .withColumn(POS, F.col(POS) - F.col("_start")).drop("_series", "_start"))


def _chunk_of(chunk_rows: int) -> Column:
    return F.floor(F.col(POS) / F.lit(chunk_rows)).cast("long")


def halo_chunks(df: DataFrame, halo: int, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Assign ``_chunk`` and copy each row into every later chunk whose first
    ``halo`` preceding positions it covers (``_halo = true`` on the copies); one
    explode, no second scan. Any ``halo`` works; copies per row are
    ``ceil(halo / chunk_rows)`` at most."""
    if halo < 0:
        raise ValueError("halo must be >= 0")
    if halo == 0:
        return df.withColumn("_chunk", _chunk_of(chunk_rows)).withColumn("_halo", F.lit(False))
    own = _chunk_of(chunk_rows)
    last = F.floor((F.col(POS) + F.lit(halo)) / F.lit(chunk_rows)).cast("long")
    return (df.withColumn("_shift", F.explode(F.sequence(F.lit(0).cast("long"), last - own)))
            .withColumn("_chunk", own + F.col("_shift"))
            .withColumn("_halo", F.col("_shift") > F.lit(0))
            .drop("_shift"))


def chunk_window() -> Window:
    return Window.partitionBy(SK, "_chunk").orderBy(POS)


def rolling(df: DataFrame, width: int, aggs: Mapping[str, Column],
            chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Trailing frames of ``width`` rows (current row included, partial frames at
    the start of a series). ``aggs`` maps output names to aggregate expressions,
    e.g. ``{"roll_max": F.max("value")}``; ``_frame_rows`` counts frame rows."""
    w = chunk_window().rowsBetween(-(width - 1), 0)
    d = halo_chunks(df, width - 1, chunk_rows)
    cols = [agg.over(w).alias(name) for name, agg in aggs.items()]
    return d.select("*", *cols).filter(~F.col("_halo")).drop("_chunk", "_halo")


def time_chunks(df: DataFrame, ts: str, span_seconds: int, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Assign ``_chunk`` (by position) and copy each row into every other chunk whose rows'
    frames ``[t - span, t]`` it may fall into (``_halo = true`` on the copies; ``_us`` is
    the time in microseconds). A chunk needs the rows from its first time less the span
    to its last time (rows of that time may stand in later chunks). Which chunks a
    chunk can reach follows from one sorted pass over the chunks' bounds, one row per
    chunk. Rows without a time are left out."""
    us = epoch_us(F.col(ts))
    span = F.lit(span_seconds * 1_000_000)
    d = df.filter(F.col(ts).isNotNull()).withColumn("_own", _chunk_of(chunk_rows)).withColumn("_us", us)
    bounds = d.groupBy(SK, F.col("_own").alias("_c")).agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"))
    bounds = staged(bounds, "chunk-bounds")
    point = lambda at, kind, c: bounds.select(SK, F.col("_c"), at.alias("_t"), F.lit(kind).alias("_k"), c.alias("_m"))
    none = F.lit(None).cast("long")
    # up to which chunk: the last whose first time is within the span of this one's last
    up = point(F.col("_first"), 0, F.col("_c")).unionByName(point(F.col("_last") + span, 1, none))
    up = up.withColumn("_to", F.max("_m").over(Window.partitionBy(SK).orderBy("_t", "_k"))).filter("_k = 1")
    # down to which chunk: the first whose last time is this one's first (times that several chunks share)
    down = point(F.col("_last"), 0, F.col("_c")).unionByName(point(F.col("_first"), 1, none))
    down = down.withColumn("_from", F.min("_m").over(Window.partitionBy(SK).orderBy(F.desc("_t"), "_k"))).filter("_k = 1")
    reach = up.select(SK, "_c", "_to").join(down.select(SK, "_c", "_from"), [SK, "_c"])
    reach = broadcast_if_small(staged(reach.withColumnRenamed("_c", "_own"), "chunk-reach"))
    copies = d.join(reach, [SK, "_own"]).withColumn(
        "_chunk", F.explode(F.sequence(F.least("_from", "_own"), F.greatest("_to", "_own"))))
    needs = broadcast_if_small(bounds.select(SK, F.col("_c").alias("_chunk"), (F.col("_first") - span).alias("_lo"),
                                             F.col("_last").alias("_hi")))
    copies = copies.join(needs, [SK, "_chunk"]).filter(F.col("_us").between(F.col("_lo"), F.col("_hi")))
    return copies.withColumn("_halo", F.col("_chunk") != F.col("_own")).drop("_own", "_to", "_from", "_lo", "_hi")


def rolling_time(df: DataFrame, ts: str, span_seconds: int, aggs: Mapping[str, Column],
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Trailing frames by time, not rows: for each row all rows of its series with a time
    in ``[t - span, t]``, both ends and rows of equal time included. Where the cadence has
    gaps this differs from :func:`rolling`. ``df`` is positioned by ``ts``; a hot series is
    split into chunks of rows. A row without a time has no frame: NULL."""
    w = Window.partitionBy(SK, "_chunk").orderBy("_us").rangeBetween(-span_seconds * 1_000_000, 0)
    cols = [agg.over(w).alias(name) for name, agg in aggs.items()]
    framed = time_chunks(df, ts, span_seconds, chunk_rows).select("*", *cols).filter(~F.col("_halo"))
    framed = framed.select(*df.columns, *aggs)
    return framed.unionByName(df.filter(F.col(ts).isNull()), allowMissingColumns=True)


def lag(df: DataFrame, cols: Mapping[str, str], offset: int = 1,
        chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Value ``offset`` rows earlier in the series (NULL at the series start)."""
    d = halo_chunks(df, offset, chunk_rows)
    w = chunk_window()
    extra = [F.lag(F.col(src), offset).over(w).alias(out) for out, src in cols.items()]
    return d.select("*", *extra).filter(~F.col("_halo")).drop("_chunk", "_halo")


def running_sum(df: DataFrame, value: Column, out: str,
                chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Inclusive running sum of ``value`` along the series (NULL counts as 0)."""
    return _sum_chunks(df.withColumn("_chunk", _chunk_of(chunk_rows)).withColumn("_v", F.coalesce(value, F.lit(0))), out)


def running_changes(df: DataFrame, flag: str, out: str, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Running count of the rows whose ``flag`` differs from the row before (the first row,
    and rows with a missing flag on either side, count). The look back and the sum share
    one exchange and one sort by chunk."""
    d = halo_chunks(df, 1, chunk_rows)
    change = F.coalesce(F.col(flag) != F.lag(F.col(flag)).over(chunk_window()), F.lit(True))
    d = d.withColumn("_v", change.cast("long")).filter(~F.col("_halo")).drop("_halo")
    return _sum_chunks(d, out)


def _sum_chunks(d: DataFrame, out: str) -> DataFrame:
    upto = chunk_window().rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_local", F.sum("_v").over(upto))
    totals = d.groupBy(SK, "_chunk").agg(F.sum("_v").alias("_tot"))
    before = Window.partitionBy(SK).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(SK, "_chunk", F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_off"))
    return (d.join(offsets, [SK, "_chunk"])
            .withColumn(out, F.col("_off") + F.col("_local"))
            .drop("_chunk", "_v", "_local", "_off"))
