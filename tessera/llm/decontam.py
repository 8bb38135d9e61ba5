"""Benchmark decontamination (3): winnowing, in DataFrame functions only.

Every window of ``WINDOW`` consecutive k-gram hashes keeps its minimum, on both sides.
Two texts that share ``K + WINDOW - 1`` words in a row share a whole window, hence its
minimum: joining the kept hashes misses no such span. Hits are then extended along
their diagonal by comparing words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, staged

#: A shared span of SPAN words is never missed: K + WINDOW - 1 = SPAN.
SPAN, K = 10, 4
WINDOW = SPAN - K + 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words in order: runs of 0-9, a-z and everything beyond ASCII, A-Z lower-cased.
    Null text: no words. (``lower`` equals the translation on texts that are all ASCII.)"""
    t = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, _UPPER, _LOWER))
    return F.array_remove(F.split(low, _BETWEEN), "")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _grams(words: Column, k: int) -> Column:
    """Hash of every k-gram, in order; ``words`` must be bound. Fewer words: empty."""
    n = F.size(words)
    at = F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.expr("array()").cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.lit(k), *[F.get(words, i + j) for j in range(k)]))


def _minima(grams: Column, window: int) -> Column:
    """Minimum of every window of hashes; ``grams`` must be bound."""
    if window == 1:
        return grams
    n = F.size(grams)
    at = F.when(n >= window, F.sequence(F.lit(0), n - window)).otherwise(F.expr("array()").cast("array<int>"))
    return F.transform(at, lambda i: F.least(*[F.get(grams, i + j) for j in range(window)]))


def fingerprints(words: Column, schemes: list[tuple[int, int]]) -> Column:
    """Distinct kept hashes for each (k, window); ``words`` must be bound."""
    return F.concat(*[_kept(words, k, window) for k, window in schemes])


def _kept(words: Column, k: int, window: int) -> Column:
    return bind(_grams(words, k), lambda g: F.array_distinct(_minima(g, window)))


def _matches(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
             span: int) -> tuple[DataFrame, DataFrame]:
    """All rows as ``(id, th, n)``, and ``(hid, hth, items, n_hit)`` of those with hits;
    the hash of the text tells rows of one id apart."""
    items = (benchmark.select(F.col(item_col).cast("string").alias("item"), words_of(F.col(item_text_col)).alias("iw"))
             .filter(F.col("item").isNotNull() & (F.size("iw") > 0)).distinct())
    items = staged(items.withColumn("ik", F.xxhash64("item", "iw")).withColumn("m", F.size("iw")), "decontam-items")
    short = [r["m"] for r in items.filter(F.col("m") < span).select("m").distinct().orderBy("m").limit(span).collect()]
    k = min(K, span)
    schemes = [(k, span - k + 1), *[(m, 1) for m in short]]

    own = F.when(F.col("m") >= span, _kept(F.col("iw"), k, span - k + 1))
    for m in short:
        own = own.when(F.col("m") == m, _kept(F.col("iw"), m, 1))
    prints = items.select("ik", F.explode(own).alias("fp"))
    marks = staged(prints.select("fp").distinct(), "decontam-marks")

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    marked = rows.select("id", "th", bind(words_of(F.col("text")), lambda w: F.struct(
        F.size(w).alias("n"), fingerprints(w, schemes).alias("fps"))).alias("s"))
    marked = staged(marked.select("id", "th", F.col("s.n").alias("n"), F.col("s.fps").alias("fps")), "decontam-docs")
    hit = marked.select("id", "th", F.explode("fps").alias("fp")).join(broadcast_if_small(marks), "fp")
    hit = staged(hit.groupBy("id", "th").agg(F.collect_set("fp").alias("fps")), "decontam-hit")

    # words of the documents that share a kept hash, and the places of those hashes
    same = (F.col("id").eqNullSafe(F.col("hid"))) & (F.col("th").eqNullSafe(F.col("hth")))
    found = rows.join(broadcast_if_small(hit.select(F.col("id").alias("hid"), F.col("th").alias("hth"), "fps")), same)
    found = staged(found.select("id", "th", "fps", words_of(F.col("text")).alias("dw")).dropDuplicates(["id", "th"]), "decontam-words")

    def places(words: Column) -> Column:
        each = [F.transform(_grams(words, a), lambda h, i: F.struct(h.alias("fp"), i.alias("at"))) for a, _ in schemes]
        return F.concat(*each)

    anchors = found.select("id", "th", F.explode(F.filter(places(F.col("dw")), lambda p: F.array_contains(F.col("fps"), p["fp"]))).alias("p"))
    anchors = anchors.select("id", "th", F.col("p.fp").alias("fp"), F.col("p.at").alias("at"))
    item_places = items.select("ik", "m", F.explode(places(F.col("iw"))).alias("p")).select(
        "ik", F.col("p.fp").alias("fp"), F.col("p.at").alias("iat")).join(marks, "fp", "left_semi")
    lines = anchors.join(broadcast_if_small(staged(item_places, "decontam-places")), "fp").select(
        "id", "th", "ik", (F.col("at") - F.col("iat")).alias("shift")).distinct()

    words = found.select(F.col("id").alias("hid"), F.col("th").alias("hth"), "dw")
    along = lines.join(words, same).join(broadcast_if_small(items), "ik")
    lo, hi = F.greatest(F.lit(0), F.col("shift")), F.least(F.size("dw"), F.col("shift") + F.col("m"))
    along = along.withColumn("lo", lo).withColumn("len", F.greatest(F.lit(0), hi - lo)).withColumn("need", F.least(F.lit(span), F.col("m")))
    along = along.filter(F.col("len") >= F.col("need"))
    equal = F.zip_with(F.slice("dw", F.col("lo") + 1, F.col("len")), F.slice("iw", F.col("lo") - F.col("shift") + 1, F.col("len")),
                       lambda x, y: x == y)
    starts = bind(equal, lambda e: F.filter(F.sequence(F.lit(0), F.col("len") - F.col("need")),
                                            lambda s: F.forall(F.slice(e, s + 1, F.col("need")), lambda x: x)))
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda s: F.sequence(
        F.col("lo") + s, F.col("lo") + s + F.col("need") - 1))))
    occurs = staged(along.select("id", "th", "item", covered.alias("pos")).filter(F.size("pos") > 0), "decontam-spans")
    per_items = occurs.groupBy("id", "th").agg(F.sort_array(F.collect_set("item")).alias("items"))
    per_words = (occurs.select("id", "th", F.explode("pos").alias("pos")).distinct()
                 .groupBy("id", "th").agg(F.count("pos").alias("n_hit")))
    both = per_items.select(F.col("id").alias("hid"), F.col("th").alias("hth"), "items").join(
        per_words, (F.col("id").eqNullSafe(F.col("hid"))) & (F.col("th").eqNullSafe(F.col("hth")))).select("hid", "hth", "items", "n_hit")
    return marked.select("id", "th", "n"), staged(both, "decontam-both")


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", span: int = SPAN) -> DataFrame:
    """One row for each row of ``docs``: ``(id_col, n_words, n_hit, items)``. A window is
    ``span`` consecutive words of an item, or the whole item if it has fewer; ``n_hit``
    counts the row's words inside any occurrence of a window and ``items`` lists, sorted
    as strings, the items of which a window occurs. Null texts and texts without words
    have no words and no windows; items with a null id are left out; repeated items and
    rows count by themselves; rows equal in id and text have equal results. Very short
    items are found by whole-item grams, so that nothing is missed there either."""
    rows, hits = _matches(docs, benchmark, id_col, text_col, item_col, item_text_col, span)
    same = F.col("id").eqNullSafe(F.col("hid")) & F.col("th").eqNullSafe(F.col("hth"))
    out = rows.join(broadcast_if_small(hits), same, "left")
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_words"),
                      F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.expr("array()").cast("array<string>")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text", span: int = SPAN) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of any item."""
    _, hits = _matches(docs, benchmark, id_col, text_col, item_col, item_text_col, span)
    hits = broadcast_if_small(hits.select(F.col("hid").alias("__hid"), F.col("hth").alias("__hth")))
    same = docs[id_col].eqNullSafe(F.col("__hid")) & F.xxhash64(docs[text_col].cast("string")).eqNullSafe(F.col("__hth"))
    return docs.join(hits, same, "left_anti")
