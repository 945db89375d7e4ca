"""Best-fit packing of token pieces into sequences by a configuration linear program.

Only the histogram of piece lengths (at most ``capacity`` entries) reaches the driver. A
configuration is a multiset of lengths that fits one sequence; the linear program covers the
whole histogram by as few of them as possible and is solved by multiplicative weights, where
each price vector asks a knapsack dynamic programme for the best configuration. Amounts are
rounded up as far as pieces last; the program is solved again for what is left, and best fit
takes the small rest. Pieces then find their places by their rank among those of equal length.
"""

from __future__ import annotations

import base64
import math
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.tasks import lean
from churnlake.session import stage

CAPACITY = 1024
END_ID = 2
#: The special token's text, and the pre-token pattern of the vocabulary with
#: possessive quantifiers, which match the same pieces without backtracking.
SPECIAL = "<|endoftext|>"
PRE_TOKENS = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|"
              r"\s+(?!\S)|\s")


class Tokenizer:
    """Token ids of a byte-level BPE vocabulary, as little-endian 32-bit bytes."""

    def __init__(self, ranks_path: str, pattern: str, special_id: int | None):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={})
        self.special = None if special_id is None else np.array([special_id], "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.special is not None and SPECIAL in text:
            return self.special.join(map(self._plain, text.split(SPECIAL)))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        return array("I", self.encoding.encode_ordinary(text)).tobytes()


def public_tokenizer() -> tuple[str, str, int]:
    """Vocabulary file, pre-token pattern and special id of the public 50k byte-level BPE.

    The file lists the vocabulary of ``byte_bpe_50k.json`` as ranks.
    """
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), PRE_TOKENS, 50256


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, after a shorter first one."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    starts = [0, *range(first, n_tokens, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n_tokens])]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
           tokenizer: tuple[str, str, int | None] | None = None, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of every whole text: doc_id, piece, start, length, ids_crc32 (, ids).

    A document's tokens are its text's and then ``end_id``; a null text counts as empty, so
    every row has at least one piece. Rows that repeat an id give pieces that repeat it.
    """
    made = tokenizer or public_tokenizer()
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(base.dtypes)["doc_id"]
    end = np.array([end_id], "<u4").tobytes()

    @lean
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Tokenizer(*made)
        for batch in batches:
            rows, number, start, length, crc, ids = [], [], [], [], [], []
            texts = batch.column(1)
            for row in range(len(texts)):
                data = coder.encode(texts[row].as_py() or "") + end
                for k, (a, n) in enumerate(cut(len(data) // 4, capacity)):
                    part = data[4 * a:4 * (a + n)]
                    rows.append(row)
                    number.append(k)
                    start.append(a)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())),
                       pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"
    return base.mapInArrow(tokens, schema + (", ids ARRAY<INT>" if with_ids else ""))


def price(lengths: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """The configuration of greatest value within the capacity: copies of each length.

    The best filling of a room is one piece or the best of its cuts into two rooms, and never
    worse than that of the room before.
    """
    best, cut = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    single = np.zeros(capacity + 1)
    single[lengths] = values
    for room in range(1, capacity + 1):
        top, at = best[room - 1], -1                      # -1: one place stays empty
        if single[room] > top:
            top, at = single[room], 0                     # 0: one piece
        half = room // 2
        if half:
            both = best[1:half + 1] + best[room - half:room][::-1]
            k = int(both.argmax())
            if both[k] > top:
                top, at = both[k], k + 1                  # else: rooms of at and the rest
        best[room], cut[room] = top, at
    copies = np.zeros(capacity + 1, np.int64)
    rooms = [capacity]
    while rooms:
        room = rooms.pop()
        while room > 0 and cut[room] < 0:
            room -= 1
        if room > 0 and cut[room] == 0:
            copies[room] += 1
        elif room > 0:
            rooms += [int(cut[room]), room - int(cut[room])]
    return copies[lengths]


def fractional(lengths: np.ndarray, need: np.ndarray, capacity: int, rate: float = 1.0
               ) -> tuple[list[tuple[np.ndarray, float]], float]:
    """Configurations with amounts that together cover every length, and a lower bound.

    Multiplicative weights: a length's weight falls with the share of its pieces that is
    covered, a round adds the configuration that is best at prices weight per piece (asked of
    the knapsack programme), by a ``rate`` share of what its scarcest length needs. Rounds end
    when every length is covered. Any prices bound the number of sequences from below by the
    worth of all pieces over that of the best configuration; the greatest such bound is returned.
    """
    covered = np.zeros(len(lengths))
    amounts: dict[bytes, list] = {}
    bound = float(need @ lengths) / capacity
    while len(lengths) and covered.min() < 1:
        log_weight = -4.0 * np.minimum(covered, 1.0)
        weight = np.where(covered < 1, np.exp(log_weight - log_weight.max()), 1e-6)
        # a piece is worth its room, so that configurations come out full, and a long one a
        # little more, as short ones still fit when little room is left
        value = (lengths / capacity) ** 1.15 * weight
        copies = price(lengths, value, capacity)
        bound = max(bound, float(need @ value) / float(copies @ value))
        used = copies > 0
        open_ = used & (covered < 1)
        # what is nearly covered is covered wholly, so that rounds come to an end
        step = float((np.where(covered[open_] > 1 - rate, 1 - covered[open_], rate)
                      * need[open_] / copies[open_]).min())
        covered += step * copies / need
        covered[covered > 1 - 1e-9] = np.maximum(covered[covered > 1 - 1e-9], 1.0)
        amounts.setdefault(copies.tobytes(), [copies, 0.0])[1] += step
    return [(copies, amount) for copies, amount in amounts.values()], bound


def _best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> Iterator[tuple]:
    """Best fit on the histogram: each configuration as often as its pieces last."""
    left = left.copy()
    while left.any():
        copies, room = np.zeros(len(lengths), np.int64), capacity
        i = len(lengths) - 1
        while i >= 0 and room >= lengths[0]:
            n = min(room // lengths[i], left[i])
            copies[i], room = n, room - n * lengths[i]
            i -= 1
        used = copies > 0
        times = int((left[used] // copies[used]).min())
        left -= times * copies
        yield copies, times


def configurations(lengths: np.ndarray, need: np.ndarray, capacity: int = CAPACITY
                   ) -> tuple[list[tuple[np.ndarray, int]], dict]:
    """Whole numbers of configurations that hold exactly ``need`` pieces of each length.

    The program's amounts are rounded up as far as pieces last. What is left is a smaller
    histogram, for which the program is solved again while it places at least half of it; best
    fit takes the rest. The second result says what the program placed and the bound.
    """
    out, left, bound, programs = [], need.copy(), 0.0, 0
    while left.any():
        some = np.flatnonzero(left)
        solution, low = fractional(lengths[some], left[some], capacity)
        bound, programs, before = max(bound, low), programs + 1, int(left.sum())
        for copies, amount in sorted(solution, key=lambda c: (-int(c[0] @ lengths[some]), -c[1])):
            used = copies > 0
            times = min(math.ceil(amount - 1e-9),
                        int((left[some][used] // copies[used]).min()))
            if times:
                whole = np.zeros(len(lengths), np.int64)
                whole[some] = copies
                out.append((whole, times))
                left -= times * whole
        if 2 * int(left.sum()) > before:
            break
    placed = int(need.sum() - left.sum())
    out += list(_best_fit(lengths, left, capacity))
    return out, {"bound": bound, "programs": programs, "placed": placed,
                 "pieces": int(need.sum()), "sequences": sum(t for _, t in out)}


def _slots(lengths: np.ndarray, plan: list[tuple[np.ndarray, int]]):
    """Runs of slots by length: keys, first sequence, offset and copies of each run."""
    taken = dict.fromkeys(lengths.tolist(), 0)
    runs, sequence = [], 0
    for copies, times in plan:
        offset = 0
        for i in np.flatnonzero(copies)[::-1]:
            size, n = int(lengths[i]), int(copies[i])
            runs.append(((size << 44) + taken[size], sequence, offset, n))
            taken[size] += n * times
            offset += size * n
        sequence += times
    runs.sort()
    return [np.array(c, np.int64) for c in zip(*runs)] if runs else [np.empty(0, np.int64)] * 4


def pack(parts: DataFrame, capacity: int = CAPACITY, rows_per_cell: int = 20_000) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length and any others but these).

    Every piece lies whole in one sequence, and the pieces of a sequence follow each other
    from 0 without gaps. Lengths beyond the capacity raise; an empty table stays empty.
    Pieces of one length are numbered in cells by a hash of their document, so that a length
    that most pieces share is spread over many tasks.
    """
    n = parts.count()
    cells = max(1, math.ceil(n / rows_per_cell))
    held = parts.withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(cells)))
    counts = held.groupBy("length", "cell").agg(F.count("*").alias("n"))
    histogram = sorted((r[0], r[1]) for r in
                       counts.groupBy("length").agg(F.sum("n")).collect())
    lengths = np.array([h[0] for h in histogram], np.int64)
    need = np.array([h[1] for h in histogram], np.int64)
    if len(lengths) and lengths[-1] > capacity:
        raise ValueError("a piece is longer than a sequence")
    keys, first, offsets, copies = _slots(lengths, configurations(lengths, need, capacity)[0])
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select("length", "cell",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "cell").orderBy("doc_id", "piece")
    ranked = (held.withColumn("place", F.row_number().over(inside).cast("bigint") - 1)
              .join(starts, ["length", "cell"])
              .withColumn("place", F.col("place") + F.col("before"))
              .select(*parts.columns, "place"))
    at = ranked.columns.index("length")

    @lean
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(at).to_numpy()
            place = batch.column(len(batch.schema) - 1).to_numpy()
            key = (size << 44) + place
            run = np.searchsorted(keys, key, side="right") - 1
            nth = key - keys[run]
            made = [first[run] + nth // copies[run], offsets[run] + nth % copies[run] * size]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *map(pa.array, made)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return ranked.mapInArrow(assign, f"{ddl}, sequence_id BIGINT, offset BIGINT")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
                   tokenizer: tuple[str, str, int | None] | None = None,
                   with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; the tokens are made once and staged."""
    parts = stage(pieces(docs, capacity, end_id, tokenizer, with_ids), "pieces")
    return pack(parts, capacity)
