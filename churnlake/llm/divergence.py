"""How far the sources of a language differ in their terms.

Terms of a batch of texts are counted by length: those of up to 8 bytes are one 64-bit word,
those of up to 16 are two, and both are put in order by a radix sort over 16-bit digits, after
which equal terms are runs; longer terms lie in a bucket for each length and are sorted as bytes.
Counts of a batch fold in Spark. Pair values are sums over blocks of a language's terms: a
block holds the counts of all its sources, and numpy goes through it a few terms at a time.
All arithmetic is on whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.tasks import lean, release
from churnlake.session import drop_staged, stage

MIN_DOCS = 3
TOP = 200
SCALE = 1_000_000_000
CHUNK_BYTES = 1 << 20
ROWS_PER_BLOCK = 100_000
_CELLS = 1 << 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows by words, the first one leading: least digit of 16 bits first."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """(first row, lower-cased bytes, end of each row in them, more of the row follows).

    A run has about a megabyte of whole texts. A longer text comes in runs of its own, cut
    between terms, of which all but the last say that more follows.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:
                                                          texts.offset + len(texts) + 1]
    whole = texts.buffers()[2]
    data = np.frombuffer(whole, np.uint8) if whole is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        at, end = int(offsets[row]), int(offsets[row + 1])
        if end - at > CHUNK_BYTES:
            while at < end:
                stop = min(end, at + CHUNK_BYTES)
                while stop < end and _TERM[data[stop]]:
                    gap = np.flatnonzero(~_TERM[data[stop:stop + CHUNK_BYTES]])
                    stop = min(end, stop + (int(gap[0]) if len(gap) else CHUNK_BYTES))
                yield row, _LOWER[data[at:stop]], np.array([stop - at]), stop < end
                at = stop
            row += 1
            continue
        stop = int(np.searchsorted(offsets, at + CHUNK_BYTES, side="right")) - 1
        yield row, _LOWER[data[at:offsets[stop]]], offsets[row + 1:stop + 1] - at, False
        row = stop


def _terms(low: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and row of each term."""
    inside = _TERM[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[ends] = True
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(stops) + 1 - starts
    return starts, lengths, np.searchsorted(ends, starts, side="right")


def _words(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray, n: int) -> list[np.ndarray]:
    """The first 8 n bytes of terms as big-endian words, with zeros behind the end."""
    out = []
    for w in range(n):
        word = np.zeros(len(starts), np.uint64)
        for k in range(8 * w, 8 * w + 8):
            byte = low[np.minimum(starts + k, len(low) - 1)].astype(np.uint64)
            word = word << np.uint64(8) | np.where(k < lengths, byte, np.uint64(0))
        out.append(word)
    return out


def _runs(keys: list[np.ndarray], group: np.ndarray, row: np.ndarray):
    """First place of each run of equal keys and group, its length, and its distinct rows."""
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    fresh = new.copy()
    fresh[1:] |= row[1:] != row[:-1]
    ends = np.append(first[1:], len(group))
    return first, ends - first, np.add.reduceat(fresh.astype(np.int64), first)


def _strings(words: list[np.ndarray]) -> pa.Array:
    """Terms of packed words as strings."""
    raw = np.stack(words, axis=1).astype(">u8").view(np.uint8)
    used = raw != 0
    offsets = np.append(0, np.cumsum(used.sum(axis=1))).astype(np.int32)
    return pa.StringArray.from_buffers(len(raw), pa.py_buffer(offsets.tobytes()),
                                       pa.py_buffer(raw[used].tobytes()))


def count_terms(low: np.ndarray, ends: np.ndarray, group: np.ndarray
                ) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(terms, group, occurrences, rows with it) of a chunk, a bucket of lengths at a time.

    ``group`` is a number for each row.
    """
    starts, lengths, row = _terms(low, ends)
    for words, least, most in ((1, 1, 8), (2, 9, 16)):
        at = np.flatnonzero((lengths >= least) & (lengths <= most))
        if not len(at):
            continue
        keys = _words(low, starts[at], lengths[at], words)
        order = radix_order([*keys, group[row[at]].astype(np.uint64)])
        keys = [k[order] for k in keys]
        own, of = group[row[at]][order], row[at][order]
        first, n, docs = _runs(keys, own, of)
        yield _strings([k[first] for k in keys]), own[first], n, docs
    for length in np.unique(lengths[lengths > 16]):
        at = np.flatnonzero(lengths == length)
        raw = np.empty((len(at), length), np.uint8)
        step = max(1, CHUNK_BYTES // int(length))
        for a in range(0, len(at), step):
            raw[a:a + step] = low[starts[at[a:a + step]][:, None] + np.arange(length)]
        keys = raw.view(f"S{length}").reshape(-1)
        order = np.lexsort((row[at], group[row[at]], keys))
        keys, own, of = keys[order], group[row[at]][order], row[at][order]
        first, n, docs = _runs([keys], own, of)
        yield (pa.array(keys[first].tolist(), pa.binary()).cast(pa.string()), own[first], n, docs)


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with the term).

    Nulls count as ''. A chunk holds whole texts, so a document counts once for a term.
    """
    base = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in
                         ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, number = {}, np.empty(batch.num_rows, np.int64)
            for i, pair in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                number[i] = names.setdefault(pair, len(names))
            langs = pa.array([p[0] for p in names], pa.string())
            sources = pa.array([p[1] for p in names], pa.string())
            def rows(group, terms, n, seen) -> pa.RecordBatch:
                at = pa.array(group)
                return pa.RecordBatch.from_arrays(
                    [langs.take(at), sources.take(at), terms, pa.array(n), pa.array(seen)],
                    names=["lang", "source", "term", "n", "docs"])

            held: list[pa.Table] = []                # the runs of one long text
            for first, low, ends, more in _chunks(batch.column(2)):
                own = number[first:first + len(ends)]
                for terms, group, n, seen in count_terms(low, ends, own):
                    if more or held:
                        held.append(pa.table({"term": terms, "n": n}))
                    else:
                        yield rows(group, terms, n, seen)
                if held and (not more or len(held) > 64):
                    held = [pa.concat_tables(held).group_by("term").aggregate([("n", "sum")])
                            .rename_columns(["term", "n"])]
                if held and not more:
                    for part in held.pop().combine_chunks().to_batches():
                        one = np.ones(part.num_rows, np.int64)
                        yield rows(own[0] * one, part.column("term"), part.column("n"), one)

    rows = base.mapInArrow(count, "lang STRING, source STRING, term STRING, n BIGINT, docs BIGINT")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"),
                                                      F.sum("docs").alias("docs"))


def share(n: str, total: str) -> str:
    """SQL of 1 + floor(1e9 * (n + 1) / total), exact."""
    return (f"(1 + (CAST({SCALE} AS DECIMAL(10, 0)) * CAST({n} + 1 AS DECIMAL(19, 0))) "
            f"div CAST({total} AS DECIMAL(20, 0)))")


def _pair_sums(counts: DataFrame, groups: DataFrame, blocks: int) -> DataFrame:
    """lang, source, item, value: sums of (p - q)^2 / q over the terms of the counts.

    ``counts`` has lang, source, term, n; ``groups`` lang, source, n (all), v (terms). Terms are
    dealt into blocks by hash, so a language of any size is spread over the tasks.
    """
    block = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")
    left = counts.select("lang", block.alias("block"), "source", "term", "n")
    right = groups.select("lang", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                          "source", (F.col("n") + F.col("v")).alias("total"))

    def sums(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        names = right["source"].to_pylist()
        total = right["total"].to_numpy()
        place = {s: i for i, s in enumerate(names)}
        source = np.array([place[s] for s in left["source"].to_pylist()], np.int64)
        _, term = np.unique(left["term"].to_numpy(), return_inverse=True) if len(source) else (
            None, np.empty(0, np.int64))
        n = left["n"].to_numpy()
        out = np.zeros((len(names), len(names)), np.int64)
        order = np.argsort(term, kind="stable")
        term, source, n = term[order], source[order], n[order]
        n_terms = int(term[-1]) + 1 if len(term) else 0
        step = max(1, _CELLS // max(1, len(names)))
        for a in range(0, n_terms, step):
            lo, hi = np.searchsorted(term, (a, a + step))
            count = np.zeros((len(names), min(step, n_terms - a)), np.int64)
            count[source[lo:hi], term[lo:hi] - a] = n[lo:hi]
            p = _shares(count, total[:, None])
            for i in range(len(names)):
                out[i] += ((p[i] - p) ** 2 // p).sum(axis=1)
        first, second = np.nonzero(~np.eye(len(names), dtype=bool))
        labels = pa.array(names, pa.string())
        made = pa.table({"lang": pa.array([key[0].as_py()] * len(first), pa.string()),
                         "source": labels.take(pa.array(first)),
                         "item": labels.take(pa.array(second)),
                         "value": pa.array(out[first, second])})
        release()
        return made

    parts = left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block")).applyInArrow(
        sums, "lang STRING, source STRING, item STRING, value BIGINT")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(1e9 * (count + 1) / total): by 64 bits while they hold the product."""
    if count.max(initial=0) < (1 << 63) // SCALE - 1:
        return 1 + SCALE * (count + 1) // total
    return (1 + SCALE * (count.astype(object) + 1) // total).astype(np.int64)


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source",
          text_col: str = "text", min_docs: int = MIN_DOCS, top: int = TOP,
          rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank: the other sources of the language by
    divergence (part ``pair``), and the ``top`` terms that mark a source (part ``term``).

    Terms are runs of letters and of all that is not ASCII, only A-Z lower-cased; a language
    keeps those in at least ``min_docs`` of its documents. Null texts, languages and sources
    count as ''. Sources without terms take part in pairs; ties go by the item's bytes. Repeated
    rows are documents of their own; an empty table gives no rows. A language of s sources gives
    s (s - 1) pairs, so s belongs to a table of sources, not of documents. Only the three named
    columns are read.
    """
    sources = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"),
                          F.coalesce(F.col(source_col), F.lit("")).alias("source")).distinct()
    counts = stage(term_counts(docs, lang_col, source_col, text_col), "term-counts")
    kept = stage(counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs"))
                 .filter(F.col("docs") >= min_docs).select("lang", "term", "all"), "kept-terms")
    used = stage(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "all"),
                 "used-counts")
    drop_staged(counts)
    langs = kept.groupBy("lang").agg(F.sum("all").alias("all_n"), F.count("*").alias("v"))
    own = used.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = stage(sources.join(own, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("group_n", F.lit(0)).alias("group_n"),
        F.coalesce("all_n", F.lit(0)).alias("all_n"), F.coalesce("v", F.lit(0)).alias("v")),
        "source-totals")
    blocks = max(1, math.ceil(used.count() / rows_per_block))
    whole = _pair_sums(used, groups.select("lang", "source", F.col("group_n").alias("n"), "v"),
                       blocks)
    item = F.col("item")
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), item)
    pairs = whole.withColumn("rank", F.row_number().over(by)).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    # a group's totals are a few numbers on every row: no term meets all rows of its source
    valued = (used.join(groups, ["lang", "source"])
              .withColumn("p", F.expr(share("n", "group_n + v")))
              .withColumn("q", F.expr(share("all", "all_n + v"))).filter("p > q")
              .select("lang", "source", F.col("term").alias("item"),
                      F.expr("((p - q) * (p - q)) div q").alias("value")))
    terms = (valued.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
             .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
    return pairs.unionByName(terms)
