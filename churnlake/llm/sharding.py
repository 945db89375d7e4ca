"""Histogram sort: splitters from exact byte counts below probes, then one exchange.

The sort key of a row is (hash of its text, hash of its id), so equal texts lie next to each
other and a group of copies is cut only where a shard border must fall inside it. Probes are
the 4096 even boundaries of each open bracket; every round counts the bytes below them
exactly over all partitions and keeps the one bracket that holds the target.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.session import stage

#: Bits of the key that one round of probes resolves.
ROUND_BITS = 12
_LOW = -(1 << 63)


def _keyed(docs: DataFrame, id_col: str, text_col: str, columns: tuple[str, ...]) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        F.xxhash64(F.col(id_col)).alias("g"),
        *([F.struct(*columns).alias("document")] if columns else []),
    )


def _refine(rows: DataFrame, key: str, targets: list[int], total: int, slack: float):
    """For each target the key boundary with the nearest byte count below it.

    Returns (boundary, bytes below it) where that meets ``slack``; otherwise the single key
    value that spans the target, as (value, bytes below it, None).
    """
    found: dict[int, tuple] = {}
    open_cells = {t: (0, 0) for t in targets}  # target -> (cell at the current depth, below)
    depth = 0
    while open_cells:
        width = min(ROUND_BITS, 64 - depth)
        scope = rows if depth == 0 else rows.filter(
            F.shiftright(F.col(key), 64 - depth).isin(sorted({c for c, _ in open_cells.values()})))
        depth += width
        cells = sorted((r[0], r[1]) for r in scope.groupBy(
            F.shiftright(F.col(key), 64 - depth).alias("cell")).agg(F.sum("size")).collect())
        by_parent: dict[int, list[tuple[int, int]]] = {}
        for cell, size in cells:
            by_parent.setdefault(0 if depth == width else cell >> width, []).append((cell, size))
        still = {}
        for t, (parent, below) in open_cells.items():
            for cell, size in by_parent[parent]:
                if below + size >= t:
                    break
                below += size
            start, end = cell << (64 - depth), (cell + 1) << (64 - depth)
            bound, got = (start, below) if t - below <= below + size - t else (end, below + size)
            if abs(got - t) <= slack:
                found[t] = (bound, got)
            elif depth == 64:
                found[t] = (cell, below, None)
            else:
                still[t] = (cell, below)
        open_cells = still
    return found


def splitters(rows: DataFrame, n_shards: int, tolerance: float) -> list[tuple[int, int]]:
    """Lower borders (h, g) of shards 1 to n-1 over rows with ``h``, ``g`` and ``size``."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total or n_shards < 2:
        return []
    targets = sorted({round(total * i / n_shards) for i in range(1, n_shards)})
    slack = tolerance * total / n_shards
    found = _refine(rows, "h", targets, total, slack)
    inside: dict[int, list[int]] = {}
    for t, hit in found.items():
        if len(hit) == 3:
            inside.setdefault(hit[0], []).append(t)
    borders = {t: (hit[0], _LOW) for t, hit in found.items() if len(hit) == 2}
    for h, ts in inside.items():  # one text value spans these targets: go on by the id
        below = {t: found[t][1] for t in ts}
        group = rows.filter(F.col("h") == h)
        for t, hit in zip(ts, _group_borders(group, [t - below[t] for t in ts], slack)):
            borders[t] = (h, hit)
    return [borders[t] for t in [round(total * i / n_shards) for i in range(1, n_shards)]]


def _group_borders(group: DataFrame, targets: list[int], slack: float) -> list[int]:
    """As ``_refine`` on g; rows equal in both hashes stay together, on the nearer side."""
    found = _refine(group, "g", sorted(set(targets)), 0, slack)
    return [found[t][0] for t in targets]


def _shard(borders: list[tuple[int, int]]) -> Column:
    shard = F.lit(0)
    for h, g in borders:
        if h < 1 << 63:  # a border above every key leaves its shard empty
            above = (F.col("h") > h) if g >= 1 << 63 else (
                (F.col("h") > h) | ((F.col("h") == h) & (F.col("g") >= g)))
            shard = shard + above.cast("int")
    return shard.cast("int")


def shard_documents(docs: DataFrame, n_shards: int = 8, tolerance: float = 0.0005,
                    id_col: str = "doc_id", text_col: str = "text",
                    columns: tuple[str, ...] = (), rows_per_cell: int = 20_000) -> DataFrame:
    """Put every row into one of ``n_shards`` shards of near equal bytes.

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, shard and slot (gapless
    from 0 in its shard); ``columns`` of the input travel along in a struct ``document``, so
    no input column can clash. Each shard's bytes differ from the mean by at most
    ``tolerance`` of it, or by what cannot be cut: one document, or rows equal in text and id,
    which stay together. A null text counts as empty, a null id as one more id value; an
    empty table gives no rows. Slots are numbered in about ``rows_per_cell`` rows per task.
    """
    keyed = _keyed(docs, id_col, text_col, ())
    narrow = stage(keyed, "shard-keys")
    borders = splitters(narrow, n_shards, tolerance)
    n_rows = narrow.count()
    cells = max(1, math.ceil(n_rows / (n_shards * rows_per_cell)))
    rows = (_keyed(docs, id_col, text_col, columns) if columns else narrow).withColumns(
        {"shard": _shard(borders), "cell": F.pmod(F.col("g"), F.lit(cells))})
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (narrow.select(_shard(borders).alias("shard"),
                             F.pmod(F.col("g"), F.lit(cells)).alias("cell"))
               .groupBy("shard", "cell").agg(F.count("*").alias("n"))
               .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0))
                       .alias("first_slot")))
    inside = Window.partitionBy("shard", "cell").orderBy("h", "g", "doc_id")
    return (rows.withColumn("slot", F.row_number().over(inside).cast("bigint") - 1)
            .join(offsets, ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("slot") + F.col("first_slot")).alias("slot"),
                    *(["document"] if columns else [])))
