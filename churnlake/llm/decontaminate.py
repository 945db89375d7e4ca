"""Benchmark decontamination by a distributed positional inverted index.

The index is partitioned by document: each stored segment holds, for about a million words,
the sorted word hashes with their lists of positions. A window of benchmark words is found by
taking the list of its rarest word in the whole corpus, shifting it by the word's offset, and
intersecting it with the shifted lists of the other words from rare to frequent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.tasks import lean
from churnlake.llm.words import ALNUM, word_hashes
from churnlake.session import stage

WINDOW = 10
SEGMENT_WORDS = 1 << 20
#: Benchmark words that one pass over the index looks up; more take further passes.
QUERY_WORDS = 2_000_000
#: Postings of rarest words that a task follows at once.
_POSTINGS = 1 << 20

_INDEX = ("segment BIGINT, doc_ids BINARY, first BINARY, words BINARY, terms BINARY, "
          "ends BINARY, positions BINARY")


@lean
def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of runs of rows; texts lie one position apart, so no phrase spans two."""
    base, done = TaskContext.get().partitionId() << 32, 0
    held: list[tuple[np.ndarray, np.ndarray, int]] = []

    def flush():
        nonlocal held, done
        hashes = np.concatenate([h for h, _, _ in held])
        counts = np.concatenate([np.diff(e, prepend=0) for _, e, _ in held])
        rows = np.concatenate([np.arange(r, r + len(e)) for _, e, r in held])
        first = np.cumsum(counts + 1) - counts - 1
        places = np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)
        order = np.argsort(hashes, kind="stable")
        terms, at = np.unique(hashes[order], return_index=True)
        held = []
        done += 1
        return rows, [base + done - 1, first.astype(np.int64).tobytes(),
                      counts.astype(np.int64).tobytes(), terms.tobytes(),
                      np.append(at, len(hashes)).astype(np.int64).tobytes(),
                      places[order].astype(np.int32).tobytes()]

    def batch_of(ids, parts):
        rows, (segment, first, words, terms, ends, positions) = parts
        chosen = ids.take(pa.array(rows))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("id", ids.type)])) as writer:
            writer.write_batch(pa.RecordBatch.from_arrays([chosen], names=["id"]))
        blob = [[segment], [sink.getvalue().to_pybytes()], [first], [words], [terms], [ends],
                [positions]]
        kinds = [pa.int64()] + [pa.binary()] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(b, k) for b, k in zip(blob, kinds)],
            names=["segment", "doc_ids", "first", "words", "terms", "ends", "positions"])

    for batch in batches:
        n = 0
        for row, hashes, ends in word_hashes(batch.column(1), ALNUM):
            held.append((hashes, ends, row))
            n += len(hashes)
            if n >= SEGMENT_WORDS:
                yield batch_of(batch.column(0), flush())
                n = 0
        if held:
            yield batch_of(batch.column(0), flush())


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: one row per segment, with the ids and word counts of its rows."""
    return stage(docs.select(id_col, text_col).mapInArrow(_segments, _INDEX), "word-index")


class Windows:
    """Benchmark windows of up to ``WINDOW`` words as hash rows, padded with the first word.

    Equal windows are one row; ``of[ends[w - 1]:ends[w]]`` are the items that hold window w.
    """

    def __init__(self, items: list[tuple[str, str | None]], width: int = WINDOW):
        ids, texts = [i for i, _ in items], pa.array([t for _, t in items], pa.large_string())
        self.ids, grams, of, sizes = ids, [], [], []
        for row, hashes, ends in word_hashes(texts, ALNUM):
            for k, (a, b) in enumerate(zip(np.append(0, ends[:-1]), ends)):
                n = int(b - a)
                if n >= width:
                    grams.append(np.lib.stride_tricks.sliding_window_view(hashes[a:b], width))
                elif n:
                    grams.append(np.append(hashes[a:b], np.repeat(hashes[a], width - n))[None])
                else:
                    continue
                of.append(np.repeat(row + k, len(grams[-1])))
                sizes.append(np.repeat(min(n, width), len(grams[-1])))
        self.grams = np.concatenate(grams) if grams else np.empty((0, width), np.uint64)
        self.sizes = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
        self._fold(np.concatenate(of) if of else np.empty(0, np.int64))
        self.vocabulary = np.unique(self.grams)
        self.order = np.tile(np.arange(width), (len(self.sizes), 1))

    def _fold(self, of: np.ndarray) -> None:
        order = np.lexsort([*self.grams.T, self.sizes])
        grams, sizes = self.grams[order], self.sizes[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (grams[1:] != grams[:-1]).any(axis=1) | (sizes[1:] != sizes[:-1])
        self.grams, self.sizes = grams[fresh], sizes[fresh]
        n = max(1, len(self.ids))
        owned = np.unique((np.cumsum(fresh) - 1) * n + of[order])
        self.of = owned % n
        self.ends = np.searchsorted(owned // n, np.arange(len(self.sizes)), side="right")

    def items(self, found: np.ndarray) -> list[str]:
        """Sorted distinct ids of the items that hold any of the windows."""
        rows = [self.of[self.ends[w - 1] if w else 0:self.ends[w]] for w in np.unique(found)]
        return sorted({self.ids[i] for part in rows for i in part})

    def rank(self, counts: dict[int, int]) -> None:
        """Order each window's words from rare to frequent in the whole corpus; pads last."""
        n = np.array([counts.get(int(t), 0) for t in self.vocabulary], np.int64)
        often = n[np.searchsorted(self.vocabulary, self.grams)]
        often[np.arange(self.grams.shape[1]) >= self.sizes[:, None]] = np.iinfo(np.int64).max
        self.order = np.argsort(often, axis=1, kind="stable")


def _unpack(batch: pa.RecordBatch):
    for row in batch.to_pylist():
        yield (row["segment"], np.frombuffer(row["first"], np.int64),
               np.frombuffer(row["words"], np.int64), np.frombuffer(row["terms"], np.uint64),
               np.frombuffer(row["ends"], np.int64), np.frombuffer(row["positions"], np.int32))


def _term_counts(index: DataFrame, vocabulary: np.ndarray) -> dict[int, int]:
    """Corpus frequency of the benchmark's words, from the lengths of their lists."""

    @lean
    def count(batches):
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for _, _, _, terms, ends, _ in _unpack(batch):
                at = np.searchsorted(terms, vocabulary)
                has = (at < len(terms)) & (terms[np.minimum(at, len(terms) - 1)] == vocabulary
                                           ) if len(terms) else np.zeros(len(vocabulary), bool)
                total[has] += np.diff(ends)[at[has]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])],
                                         names=["term", "n"])

    rows = (index.select("segment", "first", "words", "terms", "ends",
                         F.lit(b"").alias("positions"))
            .mapInArrow(count, "term BIGINT, n BIGINT").groupBy("term").agg(F.sum("n")).collect())
    return {int(vocabulary[r[0]]): r[1] for r in rows}


def _matches(windows: Windows, terms, ends, positions, slop: int):
    """(window, start) of every match in one segment."""
    if not len(terms) or not len(windows.of):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.searchsorted(terms, windows.vocabulary)
    at[at == len(terms)] = 0
    known = np.where(terms[at] == windows.vocabulary, at, -1)
    grams = known[np.searchsorted(windows.vocabulary, windows.grams)]
    alive = np.flatnonzero((grams >= 0).all(axis=1))
    grams, order, sizes = grams[alive], windows.order[alive], windows.sizes[alive]
    size = int(positions.max()) + 1
    forward = np.full(size, -1, np.int32)
    forward[positions] = np.repeat(np.arange(len(terms), dtype=np.int32), np.diff(ends))
    offset = order[:, 0]
    rarest = grams[np.arange(len(alive)), offset]
    upto = np.cumsum(ends[rarest + 1] - ends[rarest])
    windows_found, starts = [], []
    for lo in range(0, int(upto[-1]) if len(upto) else 0, _POSTINGS):
        flat = np.arange(lo, min(lo + _POSTINGS, int(upto[-1])))
        window = np.searchsorted(upto, flat, side="right")
        posting = ends[rarest[window] + 1] - (upto[window] - flat)
        start = positions[posting].astype(np.int64) - offset[window]
        for k in range(1, grams.shape[1]):
            off = order[window, k]
            term = grams[window, off]
            hit = off >= sizes[window]  # padding
            for shift in range(-slop, slop + 1):
                place = start + off + shift
                good = (place >= 0) & (place < size)
                hit |= good & (forward[np.where(good, place, 0)] == term)
            window, start = window[hit], start[hit]
        windows_found.append(alive[window])
        starts.append(start)
    none = [np.empty(0, np.int64)]
    return np.concatenate(windows_found or none), np.concatenate(starts or none)


def search(index: DataFrame, windows: Windows, slop: int = 0) -> DataFrame:
    """Matches by segment row: (segment, row, spans of words, item ids); rows with any only.

    ``slop`` 0 finds exact phrases; above, each further word may lie up to so many places
    from where the phrase has it, around the exact place of the rarest word.
    """

    @lean
    def find(batches):
        for batch in batches:
            for segment, first, words, terms, ends, positions in _unpack(batch):
                window, start = _matches(windows, terms, ends, positions, slop)
                row = np.searchsorted(first, np.maximum(start, 0), side="right") - 1
                order = np.lexsort((start, row))
                window, start, row = window[order], start[order], row[order]
                rows, cut = np.unique(row, return_index=True)
                spans, items = [], []
                for r, a, b in zip(rows, cut, np.append(cut[1:], len(row))):
                    low = np.maximum(start[a:b] - first[r] - slop, 0)
                    high = np.minimum(start[a:b] - first[r] + windows.sizes[window[a:b]] + slop,
                                      words[r])
                    pairs = np.unique(np.stack([low, high], axis=1), axis=0)
                    spans.append([{"a": int(x), "b": int(y)} for x, y in pairs])
                    items.append(windows.items(window[a:b]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), segment)), pa.array(rows.astype(np.int64)),
                     pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                     pa.array(items, pa.list_(pa.string()))],
                    names=["segment", "row", "spans", "items"])

    return index.mapInArrow(find, "segment BIGINT, row BIGINT, "
                                  "spans ARRAY<STRUCT<a: BIGINT, b: BIGINT>>, items ARRAY<STRING>")


def _index_rows(index: DataFrame, kind: str) -> DataFrame:
    @lean
    def rows(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = pa.ipc.open_stream(row["doc_ids"]).read_all()["id"].combine_chunks()
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["segment"])), pa.array(np.arange(n)), ids,
                     pa.array(np.frombuffer(row["words"], np.int64))],
                    names=["segment", "row", "doc_id", "n_words"])

    return (index.select("segment", "doc_ids", "words")
            .mapInArrow(rows, f"segment BIGINT, row BIGINT, doc_id {kind}, n_words BIGINT"))


def query_blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list]:
    """Items in blocks of about ``limit`` words (or one longer item), one block in memory."""
    block, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("string"), text_col).toLocalIterator()
    for item, text in rows:
        n = len(text or "") // 4 + 1
        if block and size + n > limit:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += n
    if block:
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", slop: int = 0,
                  query_words: int = QUERY_WORDS, index: DataFrame | None = None) -> DataFrame:
    """Words and items of the benchmark found in each document.

    Returns a row per input row: doc_id, n_words, n_hit (words inside any matched window),
    spans (merged, in words) and items (distinct ids as strings, sorted). A window is
    ``WINDOW`` consecutive words of an item, or all of a shorter one. Null or empty texts and
    items have no words and match nothing; repeated rows each get their own result; an empty
    table on either side gives no hits. Items with a null id are looked up like others but
    not listed. Only the named columns are read. ``index`` is that of ``docs`` if the caller has
    built it, who may then drop it once the result is written; it is built by default.
    """
    index = build_index(docs, id_col, text_col) if index is None else index
    found = None
    for block in query_blocks(benchmark, item_col, item_text_col, query_words):
        windows = Windows([(i if i is not None else "", t) for i, t in block])
        if not len(windows.of):
            continue
        windows.rank(_term_counts(index, windows.vocabulary))
        part = search(index, windows, slop)
        part = stage(part, "matches") if found is not None else part
        found = part if found is None else found.unionByName(part)
    rows = _index_rows(index, dict(docs.select(F.col(id_col).alias("x")).dtypes)["x"])
    if found is None:
        return rows.select("doc_id", "n_words", F.lit(0).cast("bigint").alias("n_hit"),
                           F.array().cast("array<struct<a:bigint,b:bigint>>").alias("spans"),
                           F.array().cast("array<string>").alias("items"))
    merged = found.groupBy("segment", "row").agg(
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("b")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["b"]))).alias("n"),
            F.greatest(s["b"], x["b"]).alias("b")), lambda s: s["n"])
    return (rows.join(merged.withColumn("n_hit", covered), ["segment", "row"], "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("spans", F.array().cast("array<struct<a:bigint,b:bigint>>"))
                    .alias("spans"),
                    F.coalesce(F.array_remove("items", ""), F.array().cast("array<string>"))
                    .alias("items")))
