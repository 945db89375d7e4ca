"""Threshold-scaled document sketches: every shingle hash below a fixed fraction is kept.

Since the cut is a hash value and not a count, the sketch of a union is the union of the
sketches, and the share of a sketch found in another estimates containment however unequal
the two documents are. Built-in functions only.
"""

from __future__ import annotations

import math
import os.path
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Share of all shingle hashes that a sketch keeps.
FRACTION = 0.25
WORDS = 5
_COARSE = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also where lambdas use it."""
    return F.transform(F.array(value), body)[0]


def sketch(text: Column, fraction: float = FRACTION, words: int = WORDS) -> Column:
    """Sorted distinct 64-bit hashes of the text's word shingles below the cut.

    Words are runs without ASCII white space, lower-cased. A text with fewer than ``words``
    words has one shingle of all of them; one without words has an empty sketch.
    """
    if not 0 < fraction <= 0.5:
        raise ValueError("fraction must lie in (0, 0.5]")
    cut = -(1 << 63) + int(fraction * (1 << 64))
    parts = F.array_remove(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), "")

    def shingles(hashes: Column) -> Column:
        n = F.size(hashes)
        runs = F.transform(F.sequence(F.lit(0), n - words),
                           lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(words)]))
        return (F.when(n >= words, runs)
                .when(n > 0, F.array(F.xxhash64(F.array_join(F.transform(
                    hashes, lambda h: h.cast("string")), " "))))
                .otherwise(F.array().cast("array<bigint>")))

    hashed = let(F.transform(parts, lambda w: F.xxhash64(w)), shingles)
    return F.sort_array(F.array_distinct(F.filter(hashed, lambda h: h < cut)))


def as_text(kept: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash, in order."""
    return F.array_join(F.transform(kept, lambda h: F.hex(h)), "")


def containment(kept: Column, other: Column, same_text: Column) -> Column:
    """Share of a sketch that the other holds; of an empty sketch 1 for the same text, else 0."""
    return (F.when(F.size(kept) > 0, F.size(F.array_intersect(kept, other)) / F.size(kept))
            .otherwise(same_text.cast("double")))


def merge(sketches: DataFrame, keys: list[str], kept: str = "sketch") -> DataFrame:
    """Sketch of each group's union of documents, for containment in a whole collection.

    Hashes are made distinct row-wise before the group's array is put together.
    """
    return (sketches.select(*keys, F.explode(kept).alias("h")).distinct()
            .groupBy(*keys).agg(F.sort_array(F.collect_list("h")).alias(kept)))


def _place(docs: DataFrame) -> Column:
    """A number that never falls as ``doc_id`` rises: a numeric id itself, of any other the
    seven bytes after what the smallest and the largest id have in common."""
    if isinstance(docs.schema["doc_id"].dataType, T.NumericType):
        return F.col("doc_id")
    text = F.col("doc_id").cast("string")
    ends = [(e or "").encode() for e in docs.agg(F.min(text), F.max(text)).first()]
    shared = len(os.path.commonprefix(ends))
    after = F.hex(F.substring(text.cast("binary"), shared + 1, 7))
    return F.conv(F.rpad(after, 14, "0"), 16, 10).cast("bigint")


def with_next(docs: DataFrame, payload: str, rows_per_cell: int = 512) -> DataFrame:
    """Add ``next``, the payload (not null) of the row with the next ``doc_id`` in order.

    The last row gets the first one's; rows with one id follow by the hash ``tie``. The order
    is cut into cells by id (quantiles, then even steps between them), neighbours meet by a
    window inside a cell, and only the first row of each cell goes to the cell before it. Rows
    without an id, and those of an id that spans several quantiles, are cut by ``tie`` instead,
    into as many cells as their number asks for; only rows equal in id and text stay together.
    Ids may be numbers or texts (byte order); texts that differ only beyond seven bytes after
    their common start share a cell.
    """
    share = [i / _COARSE for i in range(1, _COARSE)]
    docs = docs.withColumn("place", _place(docs))
    stats = docs.agg(F.percentile_approx("place", share, 10_000), F.count("*"),
                     F.min("place"), F.max("place"), F.count("place")).first()
    spans = Counter(stats[0] or [])
    bounds = sorted(spans)
    repeated = [b for b in bounds if spans[b] > 1]
    # places of texts may stand for several ids, whose order is not that of the ties
    one = {r[0] for r in docs.filter(F.col("place").isin(repeated)).groupBy("place").agg(
        F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a = b").collect()
           } if repeated else set()
    edges = [stats[2] or 0, *bounds, stats[3] or 0]
    steps = math.ceil(max(1, stats[1]) / _COARSE / rows_per_cell)
    lows = F.array(*[F.lit(float(e)) for e in edges])
    widths = F.array(*[F.lit(max(1.0, (b - a) / steps)) for a, b in zip(edges, edges[1:])])
    at = (F.size(F.filter(F.array(*[F.lit(b) for b in bounds]),
                          lambda b: b <= F.col("place"))) if bounds else F.lit(0))
    even = F.floor((F.col("place").cast("double") - F.get(lows, F.col("at")))
                   / F.get(widths, F.col("at")))
    # parts of an id that are cut by the tie; a bound's own rows come first among those above it
    parts = F.when(F.col("place").isNull(), F.lit(max(1, round(
        _COARSE * (1 - stats[4] / max(1, stats[1]))))))
    if one:
        parts = parts.when(F.col("place") == F.get(F.array(*[F.lit(b) for b in bounds]),
                                                   F.col("at") - 1),
                           F.get(F.array(*[F.lit(spans[b] if b in one else None).cast("int")
                                           for b in bounds]), F.col("at") - 1))
    along = (F.col("tie").cast("double") / 2.0 ** 64 + 0.5) * F.col("parts")
    top = F.when(F.col("place").isNull(), F.lit(-1)).otherwise(
        2 * F.col("at") - F.when(F.col("parts").isNull(), 0).otherwise(1))
    # not nullable, so that the join below adds no filter and all branches share one exchange
    celled = docs.withColumn("at", at).withColumn("parts", parts).withColumns({
        "coarse": F.coalesce(top.cast("bigint") * 4 * _COARSE + F.coalesce(
            F.floor(along), F.lit(0)), F.lit(-1)),
        "fine": F.coalesce(F.floor(along * steps), even, F.lit(0).cast("bigint")),
    }).drop("place", "at", "parts")
    order = Window.partitionBy("coarse", "fine").orderBy("doc_id", "tie")
    rows = celled.withColumns({"next": F.lead(payload).over(order),
                               "head": F.lag(F.lit(1)).over(order).isNull()})
    across = Window.partitionBy("coarse").orderBy("fine")
    heads = rows.filter("head").select("coarse", "fine", F.col(payload).alias("item"))
    heads = heads.withColumns({"after": F.lead("item").over(across),
                               "head": F.lag(F.lit(1)).over(across).isNull()})
    # at most about 3 * _COARSE rows are left here
    ring = Window.orderBy("coarse")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = heads.filter("head").select(
        "coarse", F.coalesce(F.lead("item").over(ring), F.first("item").over(whole)).alias("top"))
    heads = heads.join(F.broadcast(tops), "coarse").select(
        "coarse", "fine", F.coalesce("after", "top").alias("after"))
    return (rows.join(heads, ["coarse", "fine"])
            .withColumn("next", F.coalesce("next", "after"))
            .drop("coarse", "fine", "head", "after"))


def edited_pairs(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Each document's sketch, the sketch of its edited text and its next document's.

    The edited text has its last half (floor) of code points replaced by as many first ones
    of the next document. Null texts count as empty; a null id sorts first; rows with equal ids
    follow by a hash of the text; an only document is its own next. Only ``doc_id`` and
    ``text`` are read, so further columns cannot clash.
    """
    base = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    base = base.withColumn("tie", F.xxhash64("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half),
                      F.substring(F.col("next"), F.lit(1), half))
    # sketches come after the exchange: computing the next one's again costs less than moving it
    return (with_next(base, "text").withColumn("edited", edited)
            .withColumns({"sketch": sketch(F.col("text"), fraction),
                          "edited_sketch": sketch(F.col("edited"), fraction),
                          "next_sketch": sketch(F.col("next"), fraction)}))
