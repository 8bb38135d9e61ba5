"""N-gram Jaccard join (10): exact set-similarity join with set-relation skipping.

Texts become sets of word shingles. Equal sets are one class, joined through its
representative. Shingles have one total order, rare before frequent; two sets can only
be similar if they share a shingle among the first of both, so only those are indexed.

* Block skipping: an index list is cut into blocks by set size, and its entries carry
  their position. Only neighbouring blocks meet, only the front part of the smaller
  set's entries is looked at, and a pair is skipped where the positions leave too few
  shingles to come.
* Derived answers: in each block every set is first compared with one leader. From two
  sets' overlaps with the same leader follow bounds on their own overlap, which refuse or
  accept most other pairs without a comparison; pairs already connected need none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ID, TEXT, broadcast_if_small, id_and_text, row_slices, staged
from tessera.llm.components import connected_components
from tessera.llm.shingles import shingle_set
from tessera.plans import ordered

#: Shingles ordered by their exact frequency (the most frequent ones); the others count
#: as rare. The order decides the cost of the join, not its result.
ORDERED = 400_000
#: Shingles a task holds before it sends them to the buckets.
HELD = 2_500_000
#: Shingles a counting bucket is meant to hold, and bits of a shingle kept in it.
BUCKET_ITEMS, BITS = 1_500_000, 24


def _pack(values: np.ndarray) -> bytes:
    """Sorted 24-bit values as compressed differences, bytes of equal weight together."""
    d = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return zstandard.compress(d.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _key(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Bucket number and ``BITS`` more bits, from the upper end of the hash."""
    return shingles >> np.uint64(64 - bits - BITS)


def frequent_shingles(source: DataFrame, k: int, most: int = ORDERED) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys and document frequencies of the at most ``most`` most frequent shingles of
    all documents, and the bucket bits of the keys. Each task sorts its shingles into
    buckets and sends them packed; the number of buckets follows the input's size."""
    size = source.agg(F.sum(F.octet_length(TEXT))).first()[0] or 0
    bits = max(4, math.ceil(math.log2(max(1, size / 6 / BUCKET_ITEMS))))

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush():
            keys = np.sort(_key(np.concatenate(held), bits))
            bucket = (keys >> np.uint64(BITS)).astype(np.int64)
            ends = np.searchsorted(bucket, np.arange((1 << bits) + 1))
            low = (keys & np.uint64((1 << BITS) - 1)).astype(np.uint32)
            full = np.flatnonzero(np.diff(ends))
            return pa.RecordBatch.from_arrays(
                [pa.array(full), pa.array([_pack(low[ends[i]:ends[i + 1]]) for i in full], pa.binary())],
                names=["bucket", "packed"])

        for b in row_slices(batches):
            for text in b.column(1).to_pylist():
                held.append(shingle_set(text, k))
                n += len(held[-1])
                if n > HELD:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by bucket; one bucket at a time is held
        now, held = None, []

        def done():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= 4
            return pa.RecordBatch.from_arrays(
                [pa.array((np.int64(now) << BITS) + values[often].astype(np.int64)), pa.array(counts[often].astype(np.int64))],
                names=["key", "df"])

        for b in batches:
            for bucket, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if bucket != now:
                    if held:
                        yield done()
                    now, held = bucket, []
                held.append(_unpack(packed))
        if held:
            yield done()

    parts = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = staged(source.mapInArrow(scatter, "bucket bigint, packed binary")
                    .repartition(min(parts, 1 << bits), "bucket").sortWithinPartitions("bucket")
                    .mapInArrow(count, "key bigint, df bigint"), "shingle-counts")
    step = F.floor(F.log2("df") * 8)
    levels = sorted(counts.groupBy(step.alias("level")).count().collect(), key=lambda r: -r["level"])
    total, lowest = 0, None
    for r in levels:  # one row for each eighth of a power of two
        if total + r["count"] > most:
            break
        total, lowest = total + r["count"], r["level"]
    if lowest is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), bits
    kept = counts.filter(step >= F.lit(lowest)).toArrow()  # at most ``most`` rows
    keys, df = kept.column("key").to_numpy().astype(np.uint64), kept.column("df").to_numpy()
    order = np.argsort(keys)
    return keys[order], df[order], bits


def _ceil_div(a, b):
    return -(-a // b)


def prefix_length(n: int, num: int, den: int) -> int:
    return n - _ceil_div(num * n, den) + 1


def _needed(na: Column, nb: Column, num: int, den: int) -> Column:
    """Least overlap of two similar sets of these sizes."""
    return F.ceil((F.lit(num) * (na + nb)) / F.lit(float(den + num)) - F.lit(1e-9))


def _fronts(source: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """``(ID, n, sig, front)``: size and digest of every document's set and its first
    shingles in the common order."""
    keys, df, bits = frequent_shingles(source, k)
    shared = source.sparkSession.sparkContext.broadcast((keys, df))  # bounded by ORDERED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, dfs = shared.value
        for b in row_slices(batches):
            n, sig, front = [], [], []
            for text in b.column(1).to_pylist():
                s = shingle_set(text, k)
                n.append(len(s))
                sig.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                if not len(s):
                    front.append(np.zeros(0, np.int64))
                    continue
                if len(often):
                    key = _key(s, bits)
                    at = np.minimum(np.searchsorted(often, key), len(often) - 1)
                    rank = np.where(often[at] == key, dfs[at], 0)
                    if rank.any():
                        s = s[np.lexsort((s, rank))]
                front.append(s[:prefix_length(len(s), num, den)].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int32()), pa.array(sig, pa.binary()), pa.array(front, pa.list_(pa.int64()))],
                names=[ID, "n", "sig", "front"])

    id_type = source.schema[ID].dataType.simpleString()
    return source.mapInArrow(run, f"{ID} {id_type}, n int, sig binary, front array<bigint>")


def _index(classes: DataFrame, num: int, den: int) -> DataFrame:
    """Entries ``(shingle, block, n, pos, rep)`` of the lists with at least two sets."""
    width = math.log(den / num) * 1.0000001
    rep_type = classes.schema["rep"].dataType.simpleString()
    schema = f"shingle bigint, n int, pos int, rep {rep_type}"

    def shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sorted by shingle: an entry stays if it equals the one before or after it
        last: pa.RecordBatch | None = None
        before = None

        def kept(b: pa.RecordBatch, before, after) -> pa.RecordBatch:
            s = b.column(0).to_numpy()
            same = np.concatenate([[before is not None and s[0] == before], s[1:] == s[:-1],
                                   [after is not None and s[-1] == after]])
            return b.filter(pa.array(same[:-1] | same[1:]))

        for b in batches:
            if not b.num_rows:
                continue
            if last is not None:
                yield kept(last, before, b.column(0)[0].as_py())
                before = last.column(0)[-1].as_py()
            last = b
        if last is not None:
            yield kept(last, before, None)

    entries = classes.select("n", "rep", F.posexplode("front").alias("pos", "shingle")).select("shingle", "n", "pos", "rep")
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = entries.repartition(parts, "shingle").sortWithinPartitions("shingle").mapInArrow(shared_only, schema)
    return lists.withColumn("block", F.floor(F.log(F.col("n").cast("double")) / F.lit(width)).cast("int"))


def _overlaps(pairs: DataFrame, source: DataFrame, k: int) -> DataFrame:
    """``(a, b, na, nb, both)`` of candidate pairs by comparing their whole sets. An id
    with several texts counts with the pair that overlaps most."""
    ids = staged(pairs.select(F.col("a").alias(ID)).unionByName(pairs.select(F.col("b").alias(ID))).distinct(), "join-ids")
    texts = staged(source.join(broadcast_if_small(ids), ID, "left_semi"), "join-texts")
    a_side = texts.select(F.col(ID).alias("a"), F.col(TEXT).alias("ta"))
    b_side = texts.select(F.col(ID).alias("b"), F.col(TEXT).alias("tb"))
    id_type = source.schema[ID].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_slices(batches):
            rows, known, set_a = [], None, None
            for ta, tb in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if ta != known:
                    known, set_a = ta, shingle_set(ta, k)
                set_b = shingle_set(tb, k)
                rows.append((len(set_a), len(set_b), len(np.intersect1d(set_a, set_b, assume_unique=True))))
            cols = [pa.array([r[i] for r in rows], pa.int32()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["a", "b", "na", "nb", "both"])

    joined = pairs.select("a", "b").join(a_side, "a").join(b_side, "b").select("a", "b", "ta", "tb")
    found = joined.mapInArrow(run, f"a {id_type}, b {id_type}, na int, nb int, both int")
    best = F.max(F.struct((F.col("both") / (F.col("na") + F.col("nb"))).alias("r"), "na", "nb", "both"))
    return found.groupBy("a", "b").agg(best.alias("m")).select("a", "b", "m.na", "m.nb", "m.both")


def similar_pairs(source: DataFrame, classes: DataFrame, k: int, num: int, den: int, every: bool = False) -> DataFrame:
    """Edges ``(a, b)`` between representatives that connect all similar sets: every
    similar pair is an edge or is connected through edges. With ``every``, all similar
    pairs (then lists and pairs of one component are not left out)."""
    index = staged(_index(classes, num, den), "join-index")
    # the leader of a block is the set that meets others in most entries
    weight = index.groupBy("rep").agg(F.count("pos").alias("w"))
    index = staged(index.join(weight, "rep"), "join-index")
    lead = index.groupBy("shingle", "block").agg(
        F.max_by(F.col("rep"), F.struct("w", "n", "rep")).alias("leader"), F.count("rep").alias("m"))
    index = staged(index.join(lead, ["shingle", "block"]).drop("w"), "join-index")

    need = lambda x, y: _needed(F.col(x), F.col(y), num, den)
    star = index.filter("rep != leader").select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()
    first = staged(_overlaps(star, source, k), "join-first")
    edges = first.filter(F.col("both") >= need("na", "nb")).select("a", "b")
    part = staged(connected_components(edges), "join-parts")

    # what is left: entries of lists in which more than one part meets
    parted = index.join(part.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    if not every:
        mixed = parted.groupBy("shingle").agg((F.min("component") != F.max("component")).alias("mixed")).filter("mixed")
        parted = parted.join(mixed.select("shingle"), "shingle", "left_semi")
    led = first.select(F.col("a").alias("rep"), F.col("b").alias("leader"), "both", F.col("nb").alias("nl")).unionByName(
        first.select(F.col("b").alias("rep"), F.col("a").alias("leader"), "both", F.col("na").alias("nl")))
    leads = F.col("rep") == F.col("leader")
    rest = staged(parted.join(led, ["rep", "leader"], "left")
                  .withColumn("lead", F.when(leads, F.col("n")).otherwise(F.col("both")))
                  .withColumn("nl", F.when(leads, F.col("n")).otherwise(F.col("nl"))).drop("both", "m"), "join-rest")
    front = F.col("n") - F.ceil(F.lit(2 * num) * F.col("n") / F.lit(float(num + den)) - F.lit(1e-9)) + 1
    small = rest.filter(F.col("pos") < front).select(
        "shingle", "nl", F.explode(F.array("block", F.col("block") + 1)).alias("block"),
        *[F.col(c).alias(f"{c}_a") for c in ("rep", "n", "pos", "component", "leader", "lead")])
    large = rest.select("shingle", "block", *[F.col(c).alias(f"{c}_b") for c in ("rep", "n", "pos", "component", "leader", "lead")])
    overlap = need("n_a", "n_b")
    by_leader = F.least("lead_a", "lead_b") + F.least(F.col("n_a") - F.col("lead_a"), F.col("n_b") - F.col("lead_b"))
    possible = (
        (F.struct("n_a", "rep_a") < F.struct("n_b", "rep_b"))
        & (F.lit(every) | (F.col("component_a") != F.col("component_b")))
        & (F.lit(num) * F.col("n_b") <= F.lit(den) * F.col("n_a"))
        & (F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) >= overlap)
        & (F.coalesce(F.col("leader_a") != F.col("leader_b"), F.lit(True))
           | F.coalesce(by_leader >= overlap, F.lit(True))))
    left = small.join(large, ["shingle", "block"]).filter(possible)
    # what both share with one leader may be more than its set can hold apart: that many they share
    derived = (F.col("leader_a") == F.col("leader_b")) & (F.col("lead_a") + F.col("lead_b") - F.col("nl") >= overlap)
    pairs = left.groupBy(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).agg(
        F.max(F.coalesce(derived, F.lit(False))).alias("derived"))
    pairs = staged(pairs.join(first.select("a", "b"), ["a", "b"], "left_anti"), "join-left")
    second = staged(_overlaps(pairs.filter("NOT derived").select("a", "b"), source, k), "join-second")
    return (edges.unionByName(pairs.filter("derived").select("a", "b"))
            .unionByName(second.filter(F.col("both") >= need("na", "nb")).select("a", "b")))


def similar_links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, num: int = 85,
                  den: int = 100) -> tuple[DataFrame, DataFrame]:
    """The join itself, as ``(links, members)``. ``members`` has ``(id_col, rep, n_shingles)``
    for each row with words: equal sets are one class, named by its smallest id. ``links``
    has every pair ``(a, b)``, a < b, of classes whose sets are similar as in
    :func:`jaccard_components`, once. Two documents link if their classes are one or a
    link; copies are not expanded into pairs. Ids with several different texts are refused
    where they name two classes (give rows ids of their own first). A null id is a member, but a class of null ids alone has a null
    name and no links. Null and wordless texts are in neither."""
    source = id_and_text(df, id_col, text_col)
    fronts = staged(_fronts(source, k, num, den), "join-fronts").filter("n > 0")
    classes = staged(fronts.groupBy("sig", "n").agg(F.min(ID).alias("rep"), F.first("front").alias("front")), "join-classes")
    members = fronts.select(ID, "sig", "n").join(classes.select("sig", "n", "rep"), ["sig", "n"]).select(
        F.col(ID).alias(id_col), "rep", F.col("n").cast("long").alias("n_shingles"))
    # several classes may share their smallest id; the join names sets by class
    named = classes.filter(F.col("rep").isNotNull())
    twice = named.groupBy("rep").count().filter("count > 1").limit(1).count()
    if twice:
        raise ValueError("similar_links needs one text for each id")
    links = similar_pairs(source.filter(F.col(ID).isNotNull()), named, k, num, den, every=True)
    return links.distinct(), members


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, num: int = 85,
                       den: int = 100) -> DataFrame:
    """``(id_col, n_shingles, component_id)``, one row for each input row. Two documents
    link if ``den * intersection >= num * union`` of their sets of ``k``-word shingles;
    the component is the smallest id reachable by links, the row's own included. Texts
    that are null or without words have 0 shingles and link with nothing. Equal sets are
    always linked. Rows that share an id are one document and link if any of them does.
    A null id takes part through equal texts only; its component is null if no equal set
    has an id. The result is exact: no list, bucket or partner is cut."""
    source = id_and_text(df, id_col, text_col)
    fronts = staged(_fronts(source, k, num, den), "join-fronts")
    words = fronts.filter("n > 0")
    classes = staged(words.groupBy("sig", "n").agg(F.min(ID).alias("rep"), F.first("front").alias("front"))
                     .filter(F.col("rep").isNotNull()), "join-classes")
    edges = similar_pairs(source.filter(F.col(ID).isNotNull()), classes, k, num, den)
    own = words.filter(F.col(ID).isNotNull()).join(classes.select("sig", "n", "rep"), ["sig", "n"]).select(
        F.col(ID).alias("a"), F.col("rep").alias("b"))
    # copies hang on their representative; an id with several texts joins their classes
    several = own.groupBy("a").agg(F.countDistinct("b").alias("c")).filter("c > 1")
    component = connected_components(edges.unionByName(own.join(several.select("a"), "a", "left_semi")))
    rep_of = classes.select("sig", "n", "rep").join(component.withColumnRenamed("node", "rep"), "rep", "left").select(
        "sig", "n", F.coalesce("component", "rep").alias("component_id"))
    out = fronts.select(ID, "n", "sig").join(rep_of, ["sig", "n"], "left")
    return out.select(F.col(ID).alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                      F.coalesce("component_id", F.when(F.col("n") == 0, F.col(ID))).alias("component_id"))


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80,
                     den: int = 100) -> DataFrame:
    """The rows of ``df``, with all their columns, that stay when one document of each
    component stays: the one of the smallest id, then of the smallest text hash. Documents
    without words all stay, null texts too. Rows that share an id but not their text are
    documents of their own, as are rows without an id, which come after all others; of
    rows equal in id and text one stays (the one whose columns hash smallest)."""
    odd = df.groupBy(F.col(id_col).alias(ID)).count().filter(F.col(ID).isNull() | (F.col("count") > 1))
    if not odd.limit(1).count():  # every row has an id of its own
        found = jaccard_components(df, id_col, text_col, k, num, den)
        gone = staged(found.filter(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias(ID)), "join-gone")
        return df.join(broadcast_if_small(gone), F.col(id_col) == F.col(ID), "left_anti")
    key = [F.col(id_col).alias("_i"), F.xxhash64(text_col).alias("_h"), F.xxhash64(text_col, F.lit(1)).alias("_g")]
    numbers = ordered.with_position(staged(df.select(*key).distinct(), "join-keys"), [], ["_i", "_h", "_g"])
    numbers = numbers.select("_i", "_h", "_g", F.col(ordered.POS).alias("_key"))
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(whole.alias("_row"), F.col(text_col).alias("_text"), *key).alias("r").join(
        numbers.alias("n"), F.col("r._i").eqNullSafe(F.col("n._i")) & (F.col("r._h") == F.col("n._h")) & (F.col("r._g") == F.col("n._g")))
    rows = staged(rows.select("_row", "_text", "_key"), "join-rows")
    found = staged(jaccard_components(rows, "_key", "_text", k, num, den).distinct(), "join-found")
    stay = found.filter((F.col("component_id") == F.col("_key")) | (F.col("n_shingles") == 0))
    kept = rows.join(stay.select("_key", "n_shingles"), "_key")
    wordless = kept.filter("n_shingles = 0").select("_row.*")
    firsts = kept.filter("n_shingles > 0").groupBy("_key").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return firsts.select("_row.*").unionByName(wordless)
