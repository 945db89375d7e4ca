"""Exact duplicates by a cuckoo-filter index over the digests of normalised texts.

The index is cut into shards by digest. A shard holds a cuckoo filter, four slots a bucket,
each with 16 bits of a digest and the number of the stored entry it stands for, so the content
lies in the filter's buckets: a digest that meets no equal fingerprint in its two buckets is
new, and a hit is verified on the whole stored digest. An insert that would move too many
others, and so any overflow, doubles the buckets and places all stored keys anew. Deletion
takes away a fingerprint once no live row has its digest.

Rows of equal digest fold on the map side and once more in a few salted groups, so a text that
a third of all rows share reaches its shard as at most ``SALTS`` records.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm.tasks import lean, release
from churnlake.session import drop_staged, stage

SLOTS, KICKS, START_BUCKETS = 4, 200, 64
SALTS = 32
ROWS_PER_SHARD = 100_000
#: Distinct digests with more than this share of all rows are joined by broadcast: at most as
#: many as the share goes into one.
HOT_SHARE = 1e-3
WHITE = " \t\n\x0b\x0c\r"
_FREE = np.int32(-1)


def normalised(text: Column) -> Column:
    """The text without ASCII white space (blank, tab to carriage return); null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


class Filter:
    """Fingerprints and entry numbers in buckets, over keys (n, 4) of 64-bit words."""

    def __init__(self, buckets: int = START_BUCKETS):
        self.keys = np.empty((0, 4), np.uint64)
        self.live = np.empty(0, bool)
        self.resizes = 0
        self._open(buckets)

    def _open(self, buckets: int) -> None:
        self.mark = np.zeros((buckets, SLOTS), np.uint16)
        self.entry = np.full((buckets, SLOTS), _FREE, np.int32)

    @classmethod
    def load(cls, keys: bytes, mark: bytes, entry: bytes) -> Filter:
        out = cls(1)
        out.keys = np.frombuffer(keys, np.uint64).reshape(-1, 4).copy()
        out.mark = np.frombuffer(mark, np.uint16).reshape(-1, SLOTS).copy()
        out.entry = np.frombuffer(entry, np.int32).reshape(-1, SLOTS).copy()
        out.live = np.zeros(len(out.keys), bool)
        out.live[out.entry[out.entry >= 0]] = True
        return out

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint (never 0), first and second bucket of each key."""
        mark = np.maximum(keys[:, 1] & np.uint64(0xFFFF), np.uint64(1)).astype(np.uint16)
        first = (keys[:, 2] & np.uint64(len(self.mark) - 1)).astype(np.int64)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        step = (mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        return bucket ^ (step & np.uint64(len(self.mark) - 1)).astype(np.int64)

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        """What the fingerprints alone say: False is certain, True may be wrong."""
        mark, first, second = self._places(keys)
        return ((self.mark[first] == mark[:, None]).any(axis=1)
                | (self.mark[second] == mark[:, None]).any(axis=1))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 if absent: fingerprint hits verified on the stored keys."""
        out = np.full(len(keys), -1, np.int64)
        mark, first, second = self._places(keys)
        for bucket in (first, second):
            for slot in range(SLOTS):
                hit = np.flatnonzero(self.mark[bucket, slot] == mark)
                at = self.entry[bucket[hit], slot]
                same = (self.keys[at] == keys[hit]).all(axis=1)
                out[hit[same]] = at[same]
        return out

    def upsert(self, keys: np.ndarray) -> np.ndarray:
        """Entries of keys that may repeat; absent ones are stored first."""
        if not len(keys):
            return np.empty(0, np.int64)
        order = np.lexsort(keys.T[::-1])
        cut = np.append(True, (keys[order[1:]] != keys[order[:-1]]).any(axis=1))
        own = keys[order[cut]]
        found = self.find(own)
        fresh = np.flatnonzero(found < 0)
        found[fresh] = len(self.keys) + np.arange(len(fresh))
        self.keys = np.concatenate([self.keys, own[fresh]])
        self.live = np.append(self.live, np.ones(len(fresh), bool))
        self._place(found[fresh])
        out = np.empty(len(keys), np.int64)
        out[order] = found[np.cumsum(cut) - 1]
        return out

    def _place(self, entries: np.ndarray) -> None:
        while int(self.live.sum()) > 0.9 * self.mark.size or not self._put(entries):
            self.resizes += 1
            self._open(2 * len(self.mark))
            entries = np.flatnonzero(self.live)

    def _put(self, entries: np.ndarray) -> bool:
        """Place entries, a round for all at once; False once kicks do not end."""
        mark, bucket, second = self._places(self.keys[entries])
        for attempt in range(2):               # free slots of the first and second bucket
            left = np.ones(len(entries), bool)
            for slot in range(SLOTS):
                want = np.flatnonzero(left)
                want = want[self.entry[bucket[want], slot] == _FREE]
                _, one = np.unique(bucket[want], return_index=True)   # one a bucket
                want = want[one]
                self.mark[bucket[want], slot] = mark[want]
                self.entry[bucket[want], slot] = entries[want]
                left[want] = False
            entries, mark, bucket, second = (x[left] for x in (entries, mark, bucket, second))
            bucket, second = second, bucket
        for kick in range(KICKS):
            if not len(entries):
                return True
            _, one = np.unique(bucket, return_index=True)
            rest = np.setdiff1d(np.arange(len(entries)), one)
            free = (self.entry[bucket[one]] == _FREE)
            slot = np.where(free.any(axis=1), np.argmax(free, axis=1),
                            (entries[one] + kick) % SLOTS)
            out_entry = self.entry[bucket[one], slot].copy()
            out_mark = self.mark[bucket[one], slot].copy()
            self.entry[bucket[one], slot], self.mark[bucket[one], slot] = entries[one], mark[one]
            moved = out_entry >= 0
            home = self._other(bucket[one][moved], out_mark[moved])
            entries = np.concatenate([out_entry[moved], entries[rest]]).astype(np.int64)
            mark = np.concatenate([out_mark[moved], mark[rest]])
            bucket = np.concatenate([home, bucket[rest]])
        return not len(entries)

    def remove(self, entries: np.ndarray) -> None:
        """Take entries out of their buckets; their keys are gone at the next ``compact``."""
        _, first, second = self._places(self.keys[entries])
        for bucket in (first, second):
            at, slot = np.nonzero(self.entry[bucket] == entries[:, None])
            self.entry[bucket[at], slot] = _FREE
            self.mark[bucket[at], slot] = 0
        self.live[entries] = False

    def compact(self) -> np.ndarray:
        """Drop the keys of removed entries; returns the old numbers of those that stay."""
        kept = np.flatnonzero(self.live)
        new = np.full(len(self.keys) + 1, -1, np.int32)      # the last stands for a free slot
        new[kept] = np.arange(len(kept))
        self.entry = new[self.entry]
        self.keys, self.live = self.keys[kept], np.ones(len(kept), bool)
        return kept


def _keys(column: pa.Array) -> np.ndarray:
    """Digests, 32 bytes each, as rows of four words."""
    data = pa.concat_arrays([pc.cast(column, pa.binary(32))])
    raw = np.frombuffer(data.buffers()[1], np.uint64) if len(data) else np.empty(0, np.uint64)
    return raw[4 * data.offset:4 * (data.offset + len(data))].reshape(-1, 4)


class CuckooIndex:
    """Staged shards and content.

    ``content`` has a row per live row: shard, digest, n_chars, id, row (its own number).
    ``shards`` has a row per shard: its filter, and per entry the number of live rows and the one
    that stays.
    """

    def __init__(self, content: DataFrame, shards: DataFrame, n_shards: int, n_rows: int):
        self.content, self.shards = content, shards
        self.n_shards, self.n_rows = n_shards, n_rows

    @staticmethod
    def rows_of(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
                ) -> DataFrame:
        """Content rows of documents; digests are those of the normalised texts."""
        digest = F.unhex(F.sha2(normalised(F.col(text_col)).cast("binary"), 256))
        made = docs.select(F.col(id_col).alias("id"), digest.alias("digest"),
                           F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("bigint")
                           .alias("n_chars"))
        return made.select(
            F.pmod(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("bigint"),
                   F.lit(n_shards)).cast("int").alias("shard"),
            "digest", "n_chars", "id", F.monotonically_increasing_id().alias("row"))

    @classmethod
    def build(cls, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              n_shards: int | None = None) -> CuckooIndex:
        """Index of all rows; one shard for about ``ROWS_PER_SHARD`` of them."""
        n_rows = docs.count()
        n_shards = n_shards or max(8, math.ceil(n_rows / ROWS_PER_SHARD))
        content = stage(cls.rows_of(docs, n_shards, id_col, text_col), "cuckoo-content")
        return cls(content, stage(_inserted(None, content, n_shards), "cuckoo-shards"),
                   n_shards, n_rows)

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
               ) -> CuckooIndex:
        """A new index with further rows; this one stays as it is."""
        last = self.content.agg(F.max("row")).first()[0]
        fresh = self.rows_of(docs, self.n_shards, id_col, text_col).withColumn(
            "row", F.col("row") + F.lit(-1 if last is None else last) + 1)
        fresh = stage(fresh, "cuckoo-fresh")
        content = stage(self.content.unionByName(fresh), "cuckoo-content")
        shards = stage(_inserted(self.shards, fresh, self.n_shards), "cuckoo-shards")
        drop_staged(fresh)
        return CuckooIndex(content, shards, self.n_shards, content.count())

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> CuckooIndex:
        """A new index without the rows of the ids given; ids that are not live change nothing.

        Digests lose as many live rows as go; those that lose all lose their fingerprint, and
        those that lose the row that stays get the best of their rows left, from the content.
        """
        gone = ids.select(F.col(id_col).alias("id")).distinct()
        content = stage(self.content.join(gone, "id", "left_anti")
                        .select(*self.content.columns), "cuckoo-content")
        lost = self.content.join(gone, "id", "left_semi").select("shard", "digest").distinct()
        # one record a touched digest: its live rows and the best of them, none for a dead one
        left = _folded(content.join(lost, ["shard", "digest"], "left_semi"))
        dead = lost.join(left.select("digest"), "digest", "left_anti").select(
            "shard", "digest", F.lit(0).cast("bigint").alias("n"),
            *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in ("n_chars", "id", "row")])
        shards = stage(_replaced(self.shards, left.unionByName(dead), self.n_shards),
                       "cuckoo-shards")
        return CuckooIndex(content, shards, self.n_shards, content.count())

    def entries(self) -> DataFrame:
        """Row per live digest: digest, group_size, keep_chars, keep_id, keep_row."""
        columns = F.arrays_zip("digests", "counts", "chars", "ids", "rows")
        return self.shards.select(F.explode(columns).alias("e")).select(
            F.col("e.digests").alias("digest"), F.col("e.counts").alias("group_size"),
            F.col("e.chars").alias("keep_chars"), F.col("e.ids").alias("keep_id"),
            F.col("e.rows").alias("keep_row"))

    def contains(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` with ``known``: whether a live row has an equal normalised text."""
        name = "known"
        while name in docs.columns:
            name += "_"
        digest = F.unhex(F.sha2(normalised(F.col(text_col)).cast("binary"), 256))
        keyed = docs.withColumn(f"{name}digest", digest)
        asked = self.rows_of(docs.select(F.lit(0).alias("id"), F.col(text_col).alias("text")),
                             self.n_shards, "id").select("shard", "digest").distinct()
        hits = _looked_up(self.shards, asked, self.n_shards).withColumnRenamed(
            "digest", f"{name}digest").withColumn(name, F.lit(True))
        return keyed.join(hits, f"{name}digest", "left").select(
            *docs.columns, F.coalesce(F.col(name), F.lit(False)).alias(name))

    def groups(self) -> DataFrame:
        """Row per live row: id, digest, keep_id, group_size, kept.

        Digests that hold a thousandth of all rows or more, hence a thousand at most, are
        broadcast; the rows of all others meet their entry in an ordinary join.
        """
        facts = self.entries()
        often = F.col("group_size") >= max(2, math.ceil(self.n_rows * HOT_SHARE))
        hot = F.broadcast(facts.filter(often)).alias("hot")
        rows = self.content.select("digest", "id", "row").join(
            hot.select("digest", F.col("group_size").alias("hot_size"),
                       F.col("keep_id").alias("hot_id"), F.col("keep_row").alias("hot_row")),
            "digest", "left")
        rare = rows.filter("hot_size IS NULL").select("digest", "id", "row").join(
            facts.filter(~often).select("digest", "group_size", "keep_id", "keep_row"), "digest")
        frequent = rows.filter("hot_size IS NOT NULL").select(
            "digest", "id", "row", F.col("hot_size").alias("group_size"),
            F.col("hot_id").alias("keep_id"), F.col("hot_row").alias("keep_row"))
        return rare.unionByName(frequent).select(
            "id", "digest", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"))


def _best() -> Column:
    """The row that stays: most code points, then the smallest id (nulls last), then row."""
    return F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("id").isNull().alias("none"),
                          "id", "row"))


def _folded(content: DataFrame, salts: int = 1) -> DataFrame:
    """Records shard, digest, n, n_chars, id, row: at most ``salts`` for a digest."""
    keys = ["shard", "digest"] + ([F.pmod(F.col("row"), F.lit(salts))] if salts > 1 else [])
    return content.groupBy(*keys).agg(F.count("*").alias("n"), _best().alias("best")).select(
        "shard", "digest", "n", (-F.col("best.less")).alias("n_chars"), F.col("best.id").alias("id"),
        F.col("best.row").alias("row"))


_STATE = ("shard INT, resizes INT, mark BINARY, entry BINARY, digests ARRAY<BINARY>, "
          "counts ARRAY<BIGINT>, chars ARRAY<BIGINT>, ids ARRAY<{}>, rows ARRAY<BIGINT>")


class Shard:
    """A filter and, per record of an entry, how many rows it stands for and the best one."""

    def __init__(self, id_type: pa.DataType):
        self.filter = Filter()
        self.id_type = id_type
        self.at: list[np.ndarray] = []
        self.held: list[pa.Table] = []

    @classmethod
    def load(cls, row: pa.RecordBatch, at: int, id_type: pa.DataType) -> Shard:
        out = cls(id_type)
        one = {n: row.column(n)[at] for n in row.schema.names}
        digests = one["digests"].values
        raw = b"".join(digests.to_pylist())
        out.filter = Filter.load(raw, one["mark"].as_py(), one["entry"].as_py())
        out.filter.resizes = one["resizes"].as_py()
        out._hold(np.arange(len(digests)), *(one[c].values for c in ("counts", "chars", "ids",
                                                                    "rows")))
        return out

    def _hold(self, at: np.ndarray, n, chars, ids, rows) -> None:
        self.at.append(at)
        self.held.append(pa.table({"n": n, "chars": chars, "id": ids, "row": rows}))

    def add(self, part: pa.RecordBatch) -> None:
        at = self.filter.upsert(_keys(part.column("digest")))
        self._hold(at, *(part.column(c) for c in ("n", "n_chars", "id", "row")))

    def replace(self, part: pa.RecordBatch) -> None:
        """Records take the place of their digests' former ones; those of no rows remove."""
        at = self.filter.find(_keys(part.column("digest")))
        part, at = part.filter(pa.array(at >= 0)), at[at >= 0]
        self.at = [np.where(np.isin(a, at), -1, a) for a in self.at]
        n = part.column("n").to_numpy()
        self.filter.remove(at[n == 0])
        self._hold(np.where(n > 0, at, -1), *(part.column(c) for c in ("n", "n_chars", "id", "row")))

    def batch(self, shard: int) -> pa.RecordBatch:
        """The state row; of an entry's records the best stays, with the sum of their rows."""
        all_ = pa.concat_tables(self.held).append_column(
            "at", pa.array(np.concatenate(self.at))) if self.held else pa.table(
            {"n": pa.array([], pa.int64()), "chars": pa.array([], pa.int64()),
             "id": pa.array([], self.id_type), "row": pa.array([], pa.int64()),
             "at": pa.array([], pa.int64())})
        all_ = all_.filter(pc.greater_equal(all_["at"], 0))
        kept = self.filter.compact()
        order = pc.sort_indices(all_, [("at", "ascending"), ("chars", "descending"),
                                       ("id", "ascending"), ("row", "ascending")],
                                null_placement="at_end")
        ranked = all_.take(order)
        at = ranked["at"].to_numpy()
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.empty(0, int)
        count = np.add.reduceat(ranked["n"].to_numpy(), first) if len(at) else np.empty(0, np.int64)
        assert len(first) == len(kept)
        best = ranked.take(pa.array(first)).combine_chunks()

        def listed(values) -> pa.Array:
            if isinstance(values, pa.ChunkedArray):
                values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array(
                    [], values.type)
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        raw = self.filter.keys.tobytes()
        digests = pa.array([raw[i:i + 32] for i in range(0, len(raw), 32)], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([self.filter.resizes], pa.int32()),
             pa.array([self.filter.mark.tobytes()], pa.binary()),
             pa.array([self.filter.entry.tobytes()], pa.binary()), listed(digests),
             listed(pa.array(count)), listed(best["chars"]), listed(best["id"]),
             listed(best["row"])],
            names=["shard", "resizes", "mark", "entry", "digests", "counts", "chars", "ids", "rows"])


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        for own in np.unique(shard):
            yield int(own), batch.filter(pa.array(shard == own))


def _inserted(shards: DataFrame | None, fresh: DataFrame, n_shards: int) -> DataFrame:
    """Shards with the rows of ``fresh`` in them: streams of records, a state row a shard."""
    records = _folded(fresh, SALTS)
    kind = dict(records.dtypes)["id"]
    if shards is None:
        @lean
        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made: dict[int, Shard] = {}
            for own, part in _by_shard(batches):
                if own not in made:
                    made[own] = Shard(part.schema.field("id").type)
                made[own].add(part)
            for own in sorted(made):
                yield made.pop(own).batch(own)

        return records.repartition(n_shards, "shard").mapInArrow(build, _STATE.format(kind))
    return _merged(shards, records, kind, "add")


def _replaced(shards: DataFrame, records: DataFrame, n_shards: int) -> DataFrame:
    return _merged(shards, records, dict(records.dtypes)["id"], "replace")


def _merged(shards: DataFrame, records: DataFrame, kind: str, how: str) -> DataFrame:
    def merge(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        id_type = right.schema.field("id").type
        states = left.combine_chunks().to_batches()
        shard = Shard.load(states[0], 0, id_type) if states else Shard(id_type)
        for part in right.to_batches():
            getattr(shard, how)(part)
        out = pa.Table.from_batches([shard.batch(key[0].as_py())])
        release()
        return out

    return shards.groupBy("shard").cogroup(records.groupBy("shard")).applyInArrow(
        merge, _STATE.format(kind))


def _looked_up(shards: DataFrame, asked: DataFrame, n_shards: int) -> DataFrame:
    """The digests asked for that live in the index."""
    state = shards.withColumn("ids", F.col("counts"))      # ids are not needed here

    def look(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        states = left.combine_chunks().to_batches()
        digests = right["digest"].combine_chunks()
        if not states or not len(digests):
            return pa.table({"digest": pa.array([], pa.binary())})
        shard = Shard.load(states[0], 0, pa.int64())
        if isinstance(digests, pa.ChunkedArray):
            digests = digests.chunk(0)
        return pa.table({"digest": digests.filter(pa.array(shard.filter.find(_keys(digests)) >= 0))})

    return state.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(
        look, "digest BINARY")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
                     ) -> DataFrame:
    """Row per document: the id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are without ASCII white space; null counts as empty. The row
    with the most code points stays, then that with the smallest id (a null id comes last).
    Rows that repeat an id are rows of their own: of equal ones exactly one is kept. An empty
    table gives no rows; only the two named columns are read.
    """
    index = CuckooIndex.build(docs, id_col, text_col)
    return index.groups().select(
        F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("bigint"), "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))
