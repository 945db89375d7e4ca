"""Exact URL lists as cascades of Bloom filters over the corpus's complete key universe.

Level 1 encodes the listed keys, level 2 the other keys of the universe that level 1 lets
through, level 3 the listed keys that level 2 lets through, and so on until a level lets
nothing wrong through. For every key of the universe the number of levels it passes then
tells its membership exactly, and pages need no join with the lists.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.session import small_frame, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of all levels of one cascade that may be sent to the executors.
MAX_BYTES = 64 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def positions(hashes: np.ndarray, level: int, bits: int, k: int) -> np.ndarray:
    """Bit positions of 64-bit key hashes in a level, one row for each of ``k`` probes."""
    with np.errstate(over="ignore"):
        a = _mix(hashes.view(np.uint64) + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15))
        b = _mix(a) | np.uint64(1)
        return np.stack([(a + np.uint64(i) * b) % np.uint64(bits) for i in range(k)])


class Cascade:
    """Levels of (bits, number of bits, probes); sent to tasks inside a closure."""

    def __init__(self, levels: list[tuple[np.ndarray, int, int]]):
        self.levels = levels

    @property
    def size(self) -> int:
        return sum(words.nbytes for words, _, _ in self.levels)

    def passes(self, level: int, hashes: np.ndarray) -> np.ndarray:
        words, bits, k = self.levels[level]
        hit = np.ones(len(hashes), bool)
        for at in positions(hashes, level, bits, k):
            hit &= (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return hit

    def member(self, hashes: np.ndarray) -> np.ndarray:
        """Exact for keys of the universe: listed iff an odd number of levels is passed."""
        inside = np.zeros(len(hashes), bool)
        left = np.arange(len(hashes))
        for level in range(len(self.levels)):
            left = left[self.passes(level, hashes[left])]
            inside[left] = level % 2 == 0
        return inside


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        yield batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _filter(keys: DataFrame, n: int, level: int, rate: float) -> tuple[np.ndarray, int, int]:
    """One level over a frame of key hashes; tasks send set words, combined by ``bit_or``."""
    bits = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
    k = max(1, round(bits / max(1, n) * math.log(2)))
    k = min(k, 16)

    def words(batches):
        for hashes in _hash_batches(batches):
            at = np.unique(positions(hashes, level, bits, k))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            if len(word):
                value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))],
                    names=["word", "bits"])

    rows = (keys.mapInArrow(words, "word BIGINT, bits BIGINT")
            .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(bits // 64 + 1, np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out, bits, k


def build_cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> Cascade:
    """Cascade for the listed key hashes over the universe's (frames of one column ``h``).

    Listed keys outside the universe are left out, as nobody can ask for them. The driver
    holds the levels only, whose size is checked against ``max_bytes`` before each is built.
    """
    include = listed.select("h").distinct().join(universe.select("h"), "h", "left_semi")
    include = stage(include, "cascade-listed")
    exclude = stage(universe.select("h").distinct().join(include, "h", "left_anti"),
                    "cascade-others")
    n_in, n_out = include.count(), exclude.count()
    levels: list[tuple[np.ndarray, int, int]] = []
    while n_in and (n_out or not levels):
        rate = min(0.5, max(n_in / max(1, n_out), 1e-6) * math.sqrt(0.5)) if not levels else 0.5
        need = -n_in * math.log(rate) / math.log(2) ** 2 / 8
        if need + Cascade(levels).size > max_bytes:
            raise ValueError(f"the cascade needs over {max_bytes} bytes; split the list, or "
                             "filter by a join on the keys")
        levels.append(_filter(include, n_in, len(levels), rate))
        if len(levels) > 200:
            raise RuntimeError("two different keys share a 64-bit hash")
        cascade, level = Cascade(levels), len(levels) - 1

        def let_through(batches, cascade=cascade, level=level):
            for hashes in _hash_batches(batches):
                kept = hashes[cascade.passes(level, hashes)]
                yield pa.RecordBatch.from_arrays([pa.array(kept)], names=["h"])

        wrong = stage(exclude.mapInArrow(let_through, "h BIGINT"), "cascade-wrong")
        include, exclude = wrong, include
        n_in, n_out = wrong.count(), n_in
    return Cascade(levels)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, max_labels: int, max_parts: int) -> Column:
    """Rule keys that could fit a page, longest first (among equals, the longer host).

    A key is a host suffix of up to ``max_labels`` labels and a path prefix that ends with
    a slash and has up to ``max_parts`` segments before it; no listed key is longer.
    """
    labels, parts = F.split(host, "\\."), F.split(path, "/")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(max_labels))), lambda i:
                           F.array_join(F.slice(labels, n - i + 1, i), "."))
    prefixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts) - 1, F.lit(max_parts + 1))),
        lambda j: F.concat(F.array_join(F.slice(parts, F.lit(1), j), "/"), F.lit("/")))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(
        prefixes, lambda p: F.struct((-F.length(s) - F.length(p)).alias("size"),
                                     (-F.length(s)).alias("host"),
                                     F.concat(s, p).alias("key")))))
    return F.when(path.startswith("/"), F.transform(F.sort_array(keys), lambda k: k["key"])
                  ).otherwise(F.array().cast("array<string>"))


def judge(pages: DataFrame, allow: list[str], block: list[str], otherwise: str = "allow",
          url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """Host, path, fitting rule and verdict of every page.

    Rules are texts of host and path such as ``example.com/en/``; each path must end with a
    slash. A rule fits its host and all subdomains where the page's path starts with the rule's;
    the longest rule wins, and blocking wins if a rule is in both lists. The universe is
    all candidate keys of all pages; a page takes its first candidate that a cascade holds.
    Pages no rule fits, and those without host or path (null, no ``://``), get ``otherwise``
    and a null rule. Repeated rows stay; only the two named columns are read.
    """
    rules = allow + block
    bad = [r for r in rules if "/" not in r or not r.endswith("/")]
    if bad:
        raise ValueError(f"rules need a host and a path that ends with a slash: {bad}")
    rules = [r.split("/", 1)[0].translate(str.maketrans(UPPER, LOWER)) + "/" + r.split("/", 1)[1]
             for r in rules]
    labels = max((r.split("/")[0].count(".") + 1 for r in rules), default=1)
    parts = max((r.count("/") - 1 for r in rules), default=0)
    base = pages.select(F.col(id_col).alias("page_id"), host(F.col(url_col)).alias("host"),
                        path(F.col(url_col)).alias("path"))
    base = base.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), labels, parts))
    universe = stage(base.select(F.explode("keys").alias("key")).distinct()
                     .select(F.xxhash64("key").alias("h")), "url-universe")

    def listed(keys: list[str]) -> DataFrame:
        frame = small_frame(pages.sparkSession, [(k,) for k in keys], "key STRING")
        return frame.select(F.xxhash64("key").alias("h"))

    allowed = build_cascade(listed(rules[:len(allow)]), universe)
    blocked = build_cascade(listed(rules[len(allow):]), universe)

    def verdicts(batches):
        for batch in batches:
            keys, hashes = batch.column("keys"), batch.column("hashes")
            ends = keys.offsets.to_numpy()
            flat = hashes.flatten().to_numpy(zero_copy_only=False)
            is_blocked = blocked.member(flat)
            found = np.flatnonzero(is_blocked | allowed.member(flat))
            first = np.searchsorted(found, ends[:-1] - ends[0])
            at = np.append(found, len(flat))[np.minimum(first, len(found))]
            fits = at < ends[1:] - ends[0]
            rule = keys.flatten().take(pa.array(np.where(fits, at, 0), mask=~fits))
            says = np.where(np.append(is_blocked, False)[np.minimum(at, len(flat))],
                            "block", "allow")
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"), rule,
                 pa.array(np.where(fits, says, otherwise), pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])

    kind = dict(base.dtypes)["page_id"]
    return (base.withColumn("hashes", F.transform("keys", lambda k: F.xxhash64(k)))
            .mapInArrow(verdicts, f"page_id {kind}, host STRING, path STRING, rule STRING, "
                                  "verdict STRING"))
