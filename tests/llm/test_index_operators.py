"""Centroid clusters, the cuckoo-filter index and the divergence audit, against plain code."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from churnlake.llm import cuckoo, divergence, va_file
from churnlake.llm.queries import QUERIES
from tests.conftest import TESTDATA

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
WHITE = re.compile(r"[\x20\x09-\x0D]")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- centroid clusters -------------------------------------------------------------------

def brute_clusters(rows, dims, scale, k, rounds, seed=1):
    """(id, cluster, distance) of all kept rows, and the final centroids."""
    kept = [(i, np.floor(np.array(v, float) * scale).astype(np.int64)) for i, v in rows
            if v is not None and len(v) == dims and None not in v
            and np.isfinite(np.array(v, float)).all()]
    order = sorted(kept, key=lambda r: (
        r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1].tolist()))
    centres = [v.tolist() for _, v in order[:k]]

    def nearest(v):
        far = [sum((int(a) - b) ** 2 for a, b in zip(v, c)) for c in centres]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        sums = defaultdict(list)
        for _, v in kept:
            sums[nearest(v)[0]].append(v)
        for c, members in sums.items():
            centres[c] = [int(s) // len(members) for s in np.sum(members, axis=0)]
    return [(i, *nearest(v)) for i, v in kept], centres


def check_clusters(got, rows, dims, scale, k, rounds):
    want, centres = brute_clusters(rows, dims, scale, k, rounds)
    assert Counter((r["vec_id"], r["cluster"], r["distance"]) for r in got) == Counter(want)
    inertia = Counter()
    for _, c, d in want:
        inertia[c] += d
    for r in got:
        assert r["cluster_inertia"] == inertia[r["cluster"]]
        assert r["inertia"] == sum(inertia.values())
        assert r["centroid_sha256"] == hashlib.sha256(
            ",".join(map(str, centres[r["cluster"]])).encode()).hexdigest()


def test_op11_equals_brute_force(spark):
    rows = spark.read.parquet(f"{TESTDATA}/embeddings.parquet").select(
        "vec_id", "embedding").collect()
    got = QUERIES["op11_centroid_clusters"](spark, TESTDATA).collect()
    check_clusters(got, [tuple(r) for r in rows], 64, 64, 16, 3)


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_op11_awkward_rows(spark, bits):
    rng = np.random.default_rng(bits)
    rows = [(i, rng.normal(0, 10, 6).round(3).tolist()) for i in range(300)]
    rows += [(i, [1.5] * 6) for i in range(300, 500)]                  # a hot vector
    rows += rows[:20] + [(None, [0.25] * 6), (7, [9.0] * 6), (8, [1e6, 0.0, -1e6, 1.0, 2.0, 3.0])]
    bad = [(901, None), (902, []), (903, [1.0] * 5), (904, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
           (905, [float("nan")] * 6), (906, [float("inf")] * 6), (907, [1.0] * 7)]
    frame = spark.createDataFrame(
        [(i, v, "x", "y") for i, v in rows + bad],
        "vec_id BIGINT, embedding ARRAY<DOUBLE>, cluster STRING, cells STRING").repartition(3)
    got = va_file.cluster(frame, dims=6, scale=8, k=5, rounds=2, bits=bits).collect()
    check_clusters(got, rows, 6, 8, 5, 2)


def test_op11_few_none_and_too_large(spark):
    kind = "vec_id STRING, embedding ARRAY<FLOAT>"
    few = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0])], kind)
    got = va_file.cluster(few, dims=2, k=5).collect()
    assert sorted(r["distance"] for r in got) == [0, 0] and len({r["cluster"] for r in got}) == 2
    none = va_file.cluster(few, dims=3)
    assert none.collect() == [] and none.columns == va_file.cluster(few, dims=2).columns
    with pytest.raises(Exception, match="too large"):
        va_file.cluster(spark.createDataFrame([("a", [1e30, 0.0])], kind), dims=2).collect()


def test_op11_intervals_spare_most_distances(spark):
    """Bounds hold, and the cells decide most pairs of vectors and centroids."""
    rng = np.random.default_rng(3)
    means = rng.normal(0, 20, (16, 64))
    vectors = np.floor(means[rng.integers(0, 16, 4000)] + rng.normal(0, 4, (4000, 64))).astype(int)
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())],
                                  "id INT, v ARRAY<BIGINT>")
    file = va_file.VAFile.build(frame, 64)
    centres = np.floor(means).astype(np.int64)
    cells = file.cells.approximate(vectors)
    least, most = file.cells.tables(centres)
    exact = ((vectors[:, None, :] - centres[None]) ** 2).sum(axis=2)
    low, high = (sum(t[j][cells[:, j]] for j in range(32)) for t in (least, most))
    assert (low <= exact).all() and (exact <= high).all()
    members, totals, taken = file.sums(centres)
    found = exact.argmin(axis=1)
    assert members.tolist() == np.bincount(found, minlength=16).tolist()
    assert totals[5] == vectors[found == 5].sum(axis=0).tolist()
    assert taken < 0.1 * exact.size


# --- cuckoo-filter index ------------------------------------------------------------------

def brute_copies(rows):
    """Rows (id, text) as multiset of (id, keep_id, size, kept, digest)."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[WHITE.sub("", t or "")].append((i, len(t or "")))
    out = Counter()
    for text, members in groups.items():
        members.sort(key=lambda m: (-m[1], m[0] is None, m[0]))
        digest = hashlib.sha256(text.encode()).hexdigest()
        for place, (i, _) in enumerate(members):
            out[i, members[0][0], len(members), place == 0, digest] += 1
    return out


def as_counter(frame):
    return Counter(tuple(r) for r in frame.select("doc_id", "keep_id", "group_size", "kept",
                                                  "text_sha256").collect())


def test_op12_equals_brute_force(spark):
    rows = spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "text").collect()
    assert as_counter(QUERIES["op12_exact_duplicates"](spark, TESTDATA)) == brute_copies(rows)


def test_op12_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a b"), (5, "ab "), (6, "a  b"),
            (6, "a  b"), (None, "ab"), (7, "a b"), (8, "x" * 300_000), (9, "x " * 300_000),
            (None, "only"), (10, "\U0001F600 z"), (11, "\U0001F600z")]
    rows += [(20 + i, "hot text") for i in range(600)] + [(700, "hottext")] * 3
    frame = spark.createDataFrame([(i, t, "c", "c") for i, t in rows],
                                  "doc_id BIGINT, text STRING, digest STRING, shard STRING")
    assert as_counter(cuckoo.exact_duplicates(frame.repartition(5))) == brute_copies(rows)
    texts = frame.withColumn("doc_id", F.when(F.col("doc_id").isNotNull(),
                                              F.format_string("id%04d", "doc_id")))
    want = brute_copies([(None if i is None else f"id{i:04d}", t) for i, t in rows])
    assert as_counter(cuckoo.exact_duplicates(texts)) == want
    assert cuckoo.exact_duplicates(frame.limit(0)).collect() == []


def test_op12_insert_delete_and_lookup(spark):
    rng = np.random.default_rng(2)
    rows = [(i, f"text {rng.integers(0, 400)}" + " " * int(rng.integers(0, 9)))
            for i in range(1500)]
    kind = "doc_id BIGINT, text STRING"
    index = cuckoo.CuckooIndex.build(spark.createDataFrame(rows[:900], kind), n_shards=3)
    index = index.insert(spark.createDataFrame(rows[900:], kind))

    def result(of):
        return Counter((r["id"], r["keep_id"], r["group_size"], r["kept"], r["digest"].hex())
                       for r in of.groups().collect())

    assert result(index) == brute_copies(rows)
    gone = {i for i, t in rows if i % 3 == 0 or t.strip() in ("text 5", "text 6")}
    after = index.delete(spark.createDataFrame([(i,) for i in gone] + [(99_999,)], "doc_id BIGINT"))
    left = [(i, t) for i, t in rows if i not in gone]
    assert result(after) == brute_copies(left)
    assert result(index) == brute_copies(rows)              # the former index is as it was
    asked = spark.createDataFrame([("text5", "k"), ("text 7 ", "k"), ("nothing", "k"), (None, "k")],
                                  "text STRING, known STRING")
    live = {WHITE.sub("", t) for _, t in left}
    got = {r["text"]: r["known_"] for r in after.contains(asked).collect()}
    assert got == {t: WHITE.sub("", t or "") in live for t in ("text5", "text 7 ", "nothing", None)}
    again = after.insert(spark.createDataFrame([(5000, "text 5")], kind))
    assert result(again) == brute_copies([*left, (5000, "text 5")])


def test_op12_filter_moves_resizes_and_verifies():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, (5000, 4)).astype(np.uint64)
    keys[:40, 1] = 7                                # forty equal fingerprints: only bits tell them
    keys[:20, 2] = rng.integers(0, 2**20, 20).astype(np.uint64) << np.uint64(12)
    index = cuckoo.Filter(4)
    at = np.concatenate([index.upsert(keys[:2000]), index.upsert(keys[1000:])])
    assert (at[:2000][1000:] == at[2000:3000]).all() and len(index.keys) == 5000
    assert index.resizes > 5 and (index.find(keys) >= 0).all() and index.maybe(keys).all()
    assert (index.keys[index.find(keys)] == keys).all()
    other = rng.integers(0, 2**63, (400_000, 4)).astype(np.uint64)
    assert (index.find(other) == -1).all() and 0 < index.maybe(other).mean() < 0.01
    index.remove(index.find(keys[:3000]))
    assert (index.find(keys[:3000]) == -1).all() and (index.find(keys[3000:]) >= 0).all()
    index.compact()
    assert (index.keys[index.find(keys[3000:])] == keys[3000:]).all() and len(index.keys) == 2000


# --- divergence ---------------------------------------------------------------------------

def brute_audit(rows, min_docs=3, top=200):
    """Rows (lang, source, text) as a set of result tuples."""
    docs = [(a or "", b or "", Counter(TERM.findall((t or "").translate(LOW)))) for a, b, t in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in d[2])
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        groups = {s: Counter() for s in {d[1] for d in own}}
        for _, s, c in own:
            groups[s].update(c)
        whole = sum((groups[s] for s in groups), Counter())

        def shares(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        q, p = shares(whole), {s: shares(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept))
                     for o in groups if o != s]
            marks = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept
                     if groups[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", marks)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                for rank, (item, value) in enumerate(items, 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item, value, rank))
    return out


def as_set(frame):
    rows = [tuple(r) for r in frame.select("lang", "source", "part", "item", "value",
                                           "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_op13_equals_brute_force(spark):
    rows = spark.read.parquet(f"{TESTDATA}/documents.parquet").select(
        "lang", "source", "text").collect()
    assert as_set(QUERIES["op13_source_divergence"](spark, TESTDATA)) == brute_audit(rows)


def test_op13_awkward_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vocabulary = ["a", "Bb", "eightabc", "ninebytes", "sixteenbytesword", "seventeenbyteswor",
                  "été", "中文", "x" * 40, "y" * 41, "É", "z" * 3000]
    rows = [("en", f"s{i % 4}", " ".join(rng.choice(vocabulary, 30))) for i in range(40)]
    rows += [("en", None, "1 2 3"), (None, None, None), (None, "s0", "a-b_c a3b"), ("fr", "s1", ""),
             ("de", "s1", "eins"), ("de", "s2", "eins"), ("de", "s2", "eins eins")]
    rows += rows[:5]
    long = " ".join(rng.choice(vocabulary[:-1], 3000))            # comes in several runs
    rows += [("en", "s1", long), ("en", "s5", "q" * 3000 + " a")]
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 1 << 12)
    frame = spark.createDataFrame([(*r, "c", "c") for r in rows],
                                  "lang STRING, source STRING, text STRING, term STRING, n STRING")
    assert as_set(divergence.audit(frame.repartition(3), rows_per_block=20)) == brute_audit(rows)
    assert as_set(divergence.audit(frame, min_docs=1, top=2)) == brute_audit(rows, 1, 2)
    assert divergence.audit(frame.limit(0)).collect() == []


def test_op13_runs_of_long_texts_are_whole(monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 64)
    texts = ["one two", "", "w" * 500, "ab cd " * 100, "end"]
    total, followed = Counter(), 0
    for first, low, ends, more in divergence._chunks(pa.array(texts)):
        followed += more
        for terms, group, n, _ in divergence.count_terms(low, ends, np.arange(first, first + len(ends))):
            for term, row, k in zip(terms.to_pylist(), group, n):
                total[int(row), term] += int(k)
    assert followed > 3
    assert total == Counter((i, t) for i, text in enumerate(texts) for t in TERM.findall(text))


def test_op13_radix_order_is_stable():
    rng = np.random.default_rng(6)
    words = [rng.integers(0, 5, 4000).astype(np.uint64) << np.uint64(s) for s in (60, 17, 0)]
    assert (divergence.radix_order(words) == np.lexsort(words[::-1])).all()
    assert divergence._shares(np.array([10**12]), np.array([3 * 10**12])).tolist() == [
        1 + 10**9 * (10**12 + 1) // (3 * 10**12)]
