"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

SuperMinHash (one random permutation per element, drawn step by step) gives signatures with
correlated ranks and lower variance; drawing stops as soon as every place holds a value, as
later steps only give larger ones. Texts with equal shingle sets are one class from the start.
Classes that share a band form buckets; their links are confirmed on full shingle sets: first
each bucket's most central member against the others, then, where a bucket still holds more
than one component, all pairs of different components whose signatures come near the limit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.tasks import lean
from churnlake.llm.words import SPACED, U, mix, shingle_hashes, word_hashes
from churnlake.session import drop_staged, stage

WORDS = 5
BANDS, ROWS = 38, 5
PLACES = BANDS * ROWS
#: Bands are cut so that a pair at the limit shares none with at most this probability.
MISS = 1e-6
#: Sets up to this size are compared by 16 bits a hash, larger ones by 22.
_WIDE, _TABLE = 1024, 1 << 22
_BLOCK = 256
#: Elements whose permutations are held at once.
_ELEMENTS = 1 << 15
_OPEN = np.uint32(0xFFFFFFFF)
_STEP = U(0x9E3779B97F4A7C15)


def signatures(values: np.ndarray, ends: np.ndarray, places: int = PLACES) -> np.ndarray:
    """SuperMinHash signatures of sets of 64-bit hashes (flat, with ends); rows of uint32.

    A value holds the step in its high byte and 24 random bits below, so that the order of
    values is that of step plus random fraction. Empty sets keep open places.
    """
    n_sets = len(ends)
    out = np.full((n_sets, places), _OPEN, np.uint32)
    flat = out.reshape(-1)
    counts = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(n_sets), counts)
    hashes = values
    perm = None
    active = np.flatnonzero(counts > 0)
    with np.errstate(over="ignore"):
        for step in range(places):
            if not len(active):
                break
            if step:
                keep = np.isin(owner, active) if len(active) < n_sets else None
                if keep is not None and not keep.all():
                    owner, hashes, perm = owner[keep], hashes[keep], perm[keep]
            if perm is None:
                perm = np.tile(np.arange(places, dtype=np.uint8), (len(owner), 1))
            draw = mix(hashes + U(step + 1) * _STEP)
            other = step + (((draw & U(0xFFFFFFFF)) * U(places - step)) >> U(32)).astype(np.int64)
            rows = np.arange(len(owner))
            place = perm[rows, other].copy()
            perm[rows, other] = perm[:, step]
            value = (np.uint32(step << 24) + (draw >> U(40)).astype(np.uint32))
            at = owner * places + place
            fresh = flat[at] > value
            np.minimum.at(flat, at[fresh], value[fresh])
            active = active[(out[active] == _OPEN).any(axis=1)]
    return out


def in_pieces(values: np.ndarray, ends: np.ndarray, size: int | None = None) -> np.ndarray:
    """``signatures``, of a large set as the least of its pieces' at every place.

    A piece stops once its own places are filled; what it would still draw is larger than any
    value kept, so the whole set's least values are among those of the pieces.
    """
    size = size or _ELEMENTS
    if len(ends) != 1 or len(values) <= size:
        return signatures(values, ends)
    out = np.full((1, PLACES), _OPEN, np.uint32)
    for a in range(0, len(values), size):
        part = values[a:a + size]
        np.minimum(out, signatures(part, np.array([len(part)])), out=out)
    return out


def _batches_of_sets(texts: pa.Array, words: int):
    """(first row, flat shingle hashes, ends) for runs of rows."""
    for row, hashes, ends in word_hashes(texts, SPACED):
        yield (row, *shingle_hashes(hashes, ends, words))


@lean
def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, digest, signature = [], [], []
        for _, values, ends in _batches_of_sets(batch.column(1), WORDS):
            starts = np.append(0, ends[:-1])
            n.append(ends - starts)
            digest += [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest()
                       for a, b in zip(starts, ends)]
            # a few sets at a time: each element holds its permutation while it is drawn
            for lo, hi in _runs(ends, _ELEMENTS):
                base = starts[lo]
                signature += [s.tobytes() for s in
                              in_pieces(values[base:ends[hi - 1]], ends[lo:hi] - base)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.concatenate(n) if n else np.empty(0, np.int64)),
             pa.array(digest, pa.binary()), pa.array(signature, pa.binary())],
            names=["doc_id", "n_shingles", "digest", "signature"])


def _runs(ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    lo = 0
    while lo < len(ends):
        start = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, start + size, side="right")))
        yield lo, hi
        lo = hi


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(_features, f"doc_id {dict(base.dtypes)['doc_id']}, n_shingles BIGINT, "
                                      "digest BINARY, signature BINARY")


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows of the signature: the longest rows that keep the chance of a miss."""
    for rows in range(ROWS, 0, -1):
        if (1 - (percent / 100) ** rows) ** (PLACES // rows) <= MISS:
            return PLACES // rows, rows
    raise ValueError(f"signatures of {PLACES} places cannot find links at {percent} percent")


def _bands(bands: int, rows: int):
    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                if not batch.num_rows:
                    continue
                sig = _matrix(batch.column(1))
                wide = sig[:, :bands * rows].reshape(-1, bands, rows).astype(U)
                key = np.zeros(wide.shape[:2], U) + np.arange(bands, dtype=U) * _STEP
                for k in range(rows):
                    key = mix(key * U(3) + wide[:, :, k] + U(k + 1))
                rep = np.repeat(np.arange(len(sig)), bands)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rep)),
                     pa.array(key.reshape(-1).view(np.int64))], names=["rep", "band"])

    return cut


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), PLACES)


@lean
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full shingle sets, and the same cut to 16 bits a hash (32 in sets over ``_WIDE``)."""
    for batch in batches:
        for row, values, ends in _batches_of_sets(batch.column(1), WORDS):
            offsets = pa.array(np.append(0, ends), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(values.view(np.int64)))
            short = [values[a:b].astype(np.uint16 if b - a <= _WIDE else np.uint32).tobytes()
                     for a, b in zip(np.append(0, ends[:-1]), ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(ends)), lists, pa.array(short, pa.binary())],
                names=["rep", "shingles", "short"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) with 100 * intersection >= percent * union of their full sets."""
    both = F.size(F.array_intersect("left", "right")).cast("bigint")
    union = F.size("left") + F.size("right") - both
    return (pairs.join(sets.select(F.col("rep").alias("u"), F.col("shingles").alias("left")), "u")
            .join(sets.select(F.col("rep").alias("v"), F.col("shingles").alias("right")), "v")
            .filter((100 * F.least(F.size("left"), F.size("right"))
                     >= percent * F.greatest(F.size("left"), F.size("right")))
                    & (100 * both >= percent * union)).select("u", "v"))


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of the edges (u, v): rows (node, label).

    Union-find by rounds over all edges at once: every node hooks to the smallest label among
    its own and its neighbours' and then jumps to its label's label, until nothing changes.
    Each round is written to the shared folder, so lineage and lost executors stay cheap.
    """
    edges = stage(edges.select("u", "v").unionByName(edges.select(
        F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    labels = stage(edges.groupBy(F.col("u").alias("node")).agg(
        F.least(F.min("v"), F.first("u")).alias("label")), "labels")
    held = labels
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "v"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near")))
        hooked = labels.join(near, "node").select(
            "node", "label", F.least("label", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("next"))
        after = stage(hooked.join(jump, "to", "left").select(
            "node", F.least("to", F.coalesce("next", "to")).alias("label"),
            (F.least("to", F.coalesce("next", "to")) != F.col("label")).alias("moved")), "labels")
        labels = after.select("node", "label")
        still = not after.filter("moved").isEmpty()
        for done in (held, *([] if still else [edges])):
            drop_staged(done)
        held = after
        if not still:
            return labels


def _cross_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components within a bucket that could be links.

    ``members``: band, rep, label, n, short. Buckets are cut into blocks of about ``_BLOCK``
    members by hash, and each task compares two blocks, so a bucket of any size stays in
    bounded memory. A pair is emitted if the shingles of one whose cut hashes the other holds
    would be enough for a link; as the count is never below the true intersection, no link is
    lost, and hardly any other pair comes through.
    """
    sizes = members.groupBy("band").agg(F.ceil(F.count("*") / _BLOCK).cast("int").alias("blocks"))
    placed = members.join(sizes, "band").withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    copies = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    copies = copies.select("band", F.least("block", "with").alias("a"),
                           F.greatest("block", "with").alias("b"),
                           "block", "rep", "label", "n", "short")

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        block, a, b = (group[c].to_numpy() for c in ("block", "a", "b"))
        label, n = group["label"].to_numpy(), group["n"].to_numpy()
        values = [np.frombuffer(v, np.uint16 if k <= _WIDE else np.uint32)
                  for v, k in zip(group["short"].to_pylist(), n)]
        ends = np.cumsum(n)
        flat = np.concatenate(values).astype(np.uint32)
        low = (flat & np.uint32(0xFFFF)).astype(np.uint16)
        names, counts = np.unique(label, return_counts=True)
        us, vs = [], []
        # of two components one at least is not the largest: only its members look around
        for i in np.flatnonzero(label != names[counts.argmax()]):
            fits = 100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])
            others = np.flatnonzero(fits & (label != label[i])
                                    & ((block != block[i]) | (a[0] == b[0])))
            if not len(others):
                continue
            most = _shared(values[i].astype(np.uint16), low, ends, others, 1 << 16)
            if n[i] > _WIDE:
                wide = n[others] > _WIDE
                most[wide] = _shared(values[i] & np.uint32(_TABLE - 1),
                                     flat & np.uint32(_TABLE - 1), ends, others[wide], _TABLE)
            most = np.minimum(most, n[i])
            hit = others[100 * most >= percent * (n[i] + n[others] - most)]
            us.append(np.repeat(i, len(hit)))
            vs.append(hit)
        u = pa.array(np.concatenate(us) if us else np.empty(0, np.int64))
        v = pa.array(np.concatenate(vs) if vs else np.empty(0, np.int64))
        return pa.table({"u": group["rep"].take(u), "v": group["rep"].take(v)})

    kind = dict(members.dtypes)["rep"]
    return (copies.groupBy("band", "a", "b").applyInArrow(compare, f"u {kind}, v {kind}")
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())


def _shared(one: np.ndarray, flat: np.ndarray, ends: np.ndarray, others: np.ndarray,
            size: int) -> np.ndarray:
    """How many values of each of the other sets are among the one set's."""
    if not len(others):
        return np.empty(0, np.int64)
    table = np.zeros(size, bool)
    table[one] = True
    upto = np.append(0, np.cumsum(table[flat]))
    start = np.append(0, ends[:-1])
    return upto[ends[others]] - upto[start[others]]


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Groups of near-duplicate documents: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * intersection >= ``percent`` * union of their sets of
    five-word shingles; ``component_id`` is the smallest id reachable by links, and ``kept`` is
    set where that is the document's own. Null, empty and word-less texts have an empty set
    and stand alone. Rows with a null id are compared with nothing: null component, kept.
    Rows that repeat an id are kept or not together. An empty table gives no rows; only the
    two named columns are read; ids may be of any type with an order. Bands follow
    ``percent``: they miss a pair at 0.85 with probability 2e-10, at 0.8 with 3e-7, and at any
    other limit with at most ``MISS``; limits below 7 percent are refused.
    """
    bands_of = banding(percent)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = stage(features(base), "shingle-features")
    classes = stage(found.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("signature").alias("signature")), "classes")
    kind = dict(found.dtypes)["doc_id"]
    bands = classes.select("rep", "signature").mapInArrow(
        _bands(*bands_of), f"rep {kind}, band BIGINT")
    shared = bands.groupBy("band").agg(F.count("*").alias("members"), F.min("rep").alias("least"),
                                       F.max("rep").alias("most")).filter("least < most")
    members = stage(bands.join(shared.select("band", "members"), "band").distinct(), "buckets")
    mass = members.groupBy("rep").agg(F.sum("members").alias("mass"))
    ranked = members.join(mass, "rep")
    hubs = ranked.groupBy("band").agg(
        F.min(F.struct((-F.col("mass")).alias("mass"), "rep")).alias("hub"))
    hubs = hubs.select("band", F.col("hub.rep").alias("hub"))
    star = (members.join(hubs, "band").filter("rep <> hub")
            .select(F.least("rep", "hub").alias("u"), F.greatest("rep", "hub").alias("v"))
            .distinct())
    involved = mass.select(F.col("rep").alias("doc_id"))
    texts = base.join(involved, "doc_id", "left_semi")
    sets = stage(texts.mapInArrow(_sets, f"rep {kind}, shingles ARRAY<BIGINT>, short BINARY")
                 .dropDuplicates(["rep"]), "shingle-sets")
    links = stage(verified(star, sets, percent), "hub-links")
    labels = components(links)
    labelled = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "label", F.coalesce("label", "rep"))
    split = (labelled.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
             .filter("lo < hi").select("band"))
    rest = labelled.join(split, "band").join(
        sets.select("rep", F.size("shingles").cast("bigint").alias("n"), "short"), "rep")
    more = verified(_cross_pairs(rest.select("band", "rep", "label", "n", "short"), percent),
                    sets, percent)
    more = stage(more, "cross-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    named = (classes.select("digest", "rep").join(labels.withColumnRenamed("node", "rep"), "rep")
             .select("digest", "label"))
    # a class without links is its own component; its smallest id comes with the class
    own = classes.select("digest", "rep").join(named, "digest", "left").select(
        "digest", F.coalesce("label", "rep").alias("component_id"))
    ids = found.select("doc_id", "n_shingles", "digest")
    out = ids.join(
        own, (ids["digest"] == own["digest"]) & (ids["n_shingles"] > 0)
        & ids["doc_id"].isNotNull(), "left")
    result = stage(out.select("doc_id", "n_shingles",
                      F.coalesce("component_id", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))),
        "near-duplicates")
    for table in (found, classes, members, sets, links, more):
        drop_staged(table)
    return result
