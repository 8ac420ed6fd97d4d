"""Near and exact duplicate operators against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cartwheel.llm import components, minhash, neighbours, simhash, substrings
from cartwheel.llm.catalog import QUERIES
from conftest import SF_SMALL

DOCS = "doc_id bigint, text string, fp string, component_id int, sig int, _chunk int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], DOCS)


def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()


def roots(n, links):
    label = list(range(n))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# --- components ----------------------------------------------------------

def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 200)] + [(500, 500 + i) for i in range(1, 50)] + [(700, 701), (701, 702), (702, 700), (9, 9)]
    links += [(rng.randint(1000, 1300), rng.randint(1000, 1300)) for _ in range(200)]
    frame_ = spark.createDataFrame([(a, b) if rng.random() < 0.5 else (b, a) for a, b in links] + [(None, 3)], "a bigint, b bigint")
    want = roots(1400, links)
    got = {r.node: r.root for r in components.connected_components(frame_).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: want[i] for i in linked}
    assert components.connected_components(frame_.limit(0)).count() == 0


# --- substrings ----------------------------------------------------------

def brute_repeats(rows, window):
    seen, out = set(), []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            key = tuple(words[p:p + window])
            if key in seen:
                gone[p:p + window] = [True] * window
            seen.add(key)
        out.append((doc_id, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return out


def test_repeats_equal_brute_force_on_few_words(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))) for i in range(120)]
    rows += [(200 + i, rows[i][1] + "\n" + rows[i + 1][1]) for i in range(30)]
    rows += [(300, "a " * 500), (301, "a " * 400), (302, None), (303, ""), (304, " \t\x0b\x0c\r\n "), (305, "a b " * 50)]
    for window in (2, 6, 20):
        got = substrings.remove_repeats(frame(spark, rows), window=window, chunk_bytes=300, bucket_entries=50).collect()
        assert sorted(tuple(r) for r in got) == sorted(brute_repeats(rows, window)), window


def test_repeats_query_equals_brute_force(spark):
    want = {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute_repeats(documents(spark), 20)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op2_substring_dedup"](spark, SF_SMALL).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 0


def test_repeats_defined_cases(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text), (5, text), (None, text), (3, "short"), (None, None), (4, text)]
    got = sorted(((r.doc_id if r.doc_id is not None else 99, r.n_words, r.n_removed)
                  for r in substrings.remove_repeats(frame(spark, rows)).collect()))
    assert got == [(3, 1, 0), (4, 30, 0), (5, 30, 30), (5, 30, 30), (99, 0, 0), (99, 30, 30)]
    assert substrings.remove_repeats(frame(spark, [])).count() == 0


def test_many_equal_rows_are_one_row_of_the_search(spark):
    rng = random.Random(2)
    words = lambda n: " ".join(rng.choice("abcdefgh") for _ in range(n))
    hot, short = words(70), "few\n words  "
    rows = [(i, words(rng.randint(0, 80))) for i in range(60)] + [(7, hot)] * 30 + [(None, hot)] * 40 + [(None, short)] * 20
    rows += [(8, f"{hot} {words(5)}"), (3, short), (3, short), (None, None), (None, None)]
    tied = {(r.doc_id, r.text): r.tie for r in frame(spark, rows).select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, tied[r]))
    got = substrings.remove_repeats(frame(spark, rows).repartition(5), window=6, chunk_bytes=400, bucket_entries=50).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_repeats(order, 6)))
    plain, copies = substrings._without_copies(frame(spark, rows).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_tie", F.xxhash64("text")), 6)
    assert plain.count() == len(set(rows)) and copies.count() == len(rows) - len(set(rows))


# --- SimHash -------------------------------------------------------------

def brute_simhash(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(prints, ids):
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    label = roots(len(prints), links)
    least = {}
    for i, root in enumerate(label):
        if ids[i] is not None:
            least[root] = min(least.get(root, ids[i]), ids[i])
    return [least.get(root) for root in label]


def test_simhash_query_equals_brute_force(spark):
    rows = documents(spark)
    prints = [brute_simhash(t) for _, t in rows]
    want = {r.doc_id: (f"{p:016x}", c) for r, p, c in zip(rows, prints, brute_groups(prints, [r.doc_id for r in rows]))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash_dedup"](spark, SF_SMALL).collect()}
    assert got == want and len({c for _, c in want.values()}) < len(want)


def test_links_are_complete_for_every_bit_pair(spark):
    rng = random.Random(11)
    base = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1, 1 << 63]
    values = {b ^ m for b in base for m in [0, *(1 << i for i in range(64)), *((1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(40)),
                                            *((1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(20))]}
    lonely = {rng.getrandbits(64) for _ in range(50)}
    values = sorted(values | lonely)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    kept = simhash.with_partners(df)
    survivors = {r.fp for r in kept.collect()}
    for i, a in enumerate(values):
        if any((a ^ b).bit_count() <= 2 for b in values if b != a):
            assert signed[i] in survivors
    assert len(survivors) < len(values)
    want = roots(len(values), [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2])
    links = [(signed.index(r.a), signed.index(r.b)) for r in simhash.hamming_links(kept).collect()]
    assert all((values[i] ^ values[j]).bit_count() <= 2 for i, j in links)
    assert roots(len(values), links) == want


@pytest.mark.parametrize("segments", [3, 5, 7, 9])
def test_chain_filter_is_the_pigeonring_condition(spark, segments):
    rng = random.Random(segments)
    values = sorted({b ^ m for b in [rng.getrandbits(64) for _ in range(30)]
                     for m in [0, *(sum({1 << rng.randrange(64) for _ in range(n)}) for n in (1, 2, 3, 3, 4, 5, 6, 8))]})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {r.fp for r in simhash.with_partners(spark.createDataFrame([(v,) for v in signed], "fp bigint"), segments).collect()}
    bounds = simhash.segment_bounds(segments)

    def chain(a, b):
        """Whether some chain keeps within floor(l * 2 / segments) where that is at most 1."""
        parts = [((a ^ b) >> at & (1 << width) - 1).bit_count() for at, width in bounds]
        return any(all(sum(parts[(i + k) % segments] for k in range(n)) <= n * 2 // segments
                       for n in range(1, segments + 1) if n * 2 // segments <= 1) for i in range(segments))

    assert got == {s for v, s in zip(values, signed) if any(chain(v, w) for w in values if w != v)}


@pytest.mark.parametrize("segments, limit", [(5, 2000), (5, 3), (5, 1), (3, 2000), (7, 2000), (7, 4)])
def test_chain_links_are_complete_and_span_no_more(spark, segments, limit):
    rng = random.Random(segments * 100 + limit)
    base = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1, 1 << 63]
    values = sorted({b ^ m for b in base for m in [0, *(sum({1 << rng.randrange(64) for _ in range(n)})
                     for n in (1, 1, 1, 2, 2, 2, 3, 3, 4, 5))]} | {rng.getrandbits(64) for _ in range(40)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint").repartition(3)
    links = [(signed.index(r.a), signed.index(r.b)) for r in simhash.near_links(df, segments, group_limit=limit).collect()]
    assert all((values[i] ^ values[j]).bit_count() <= 2 for i, j in links)
    want = roots(len(values), [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2])
    assert roots(len(values), links) == want


def test_a_group_of_near_copies_gives_a_forest():
    import pyarrow as pa

    values = np.array(sorted([0, *(1 << i for i in range(40, 60)), *(1 << i | 1 << (i + 1) for i in range(40, 59))]), np.int64)
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([0] * len(rows)), pa.array([0] * len(rows)), pa.array(rows)],
                                                    names=["start", "bits", "fp"])
    for size in (1, 7, 100):
        batches = [batch(values[i:i + size]) for i in range(0, len(values), size)]
        links = [(r["a"], r["b"]) for b in simhash._forest(5, 2, iter(batches)) for r in b.to_pylist()]
        assert len(links) == len(values) - 1 and all((a ^ b).bit_count() <= 2 for a, b in links)


def test_simhash_defined_cases(spark):
    rows = [(7, None), (3, ""), (9, "  "), (4, "one two"), (4, "one two"), (None, "ONE two"), (None, "lonely text of its own words")]
    got = sorted(((r.doc_id if r.doc_id is not None else 99), r.component_id if r.component_id is not None else -1)
                 for r in simhash.near_duplicates(frame(spark, rows), F.col("doc_id"), F.col("text")).collect())
    assert got == [(3, 3), (4, 4), (4, 4), (7, 3), (9, 3), (99, -1), (99, 4)]
    assert simhash.near_duplicates(frame(spark, []), F.col("doc_id"), F.col("text")).count() == 0


def test_simhash_deduplicate_keeps_one_row_of_each_group(spark):
    rows = [(7, None), (3, ""), (4, "one two"), (4, "one two"), (2, "other words entirely here"), (None, "ONE two"), (None, "its own group of words")]
    out = simhash.deduplicate(frame(spark, rows), "doc_id", "text")
    assert out.columns == frame(spark, []).columns
    assert sorted((r.doc_id if r.doc_id is not None else 99, r.text) for r in out.collect()) == [
        (2, "other words entirely here"), (3, ""), (4, "one two"), (99, "its own group of words")]
    assert simhash.deduplicate(frame(spark, []), "doc_id", "text").count() == 0


# --- vectors -------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<float>, node int, v int")


def brute_vectors(rows):
    clean = []
    for i, v in rows:
        ok = bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        clean.append(np.array(v, np.float32).astype(float) if ok else None)
    width = max((len(c) for c in clean if c is not None), default=0)
    unit = [None if c is None else np.pad(c, (0, width - len(c))) / np.linalg.norm(c) for c in clean]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if unit[i] is not None and unit[j] is not None and unit[i] @ unit[j] >= 0.9]
    n = np.zeros(len(rows), int)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    label = roots(len(rows), links)
    least = {}
    for i, root in enumerate(label):
        least[root] = min(least.get(root, rows[i][0]), rows[i][0])
    return sorted((rows[i][0], int(n[i]), least[label[i]], rows[i][0] == least[label[i]]) for i in range(len(rows)))


@pytest.mark.parametrize("cell_rows, block_rows", [(8192, 16384), (20, 15)])
def test_vector_links_equal_brute_force(spark, cell_rows, block_rows):
    rng = np.random.default_rng(4)
    rows, at = [], 0
    for spread in (0.02, 0.1, 0.18, 0.22, 0.3):
        centre = rng.normal(size=8)
        for _ in range(40):
            rows.append((at, (centre / np.linalg.norm(centre) + spread * rng.normal(size=8)).tolist()))
            at += 1
    rows += [(at + i, rows[3][1]) for i in range(30)]  # copies
    rows += [(900, None), (901, []), (902, [0.0] * 8), (903, [1.0, None] + [0.0] * 6), (904, [float("nan")] * 8),
             (905, [float("inf")] + [1.0] * 7), (906, rows[0][1][:5]), (907, [1.0]), (908, [2.0]), (909, [1e-30] * 8), (910, [1e30] * 8)]
    out = neighbours.near_duplicates(vectors(spark, rows), "vec_id", "embedding", cell_rows=cell_rows, block_rows=block_rows)
    assert sorted(tuple(r) for r in out.collect()) == brute_vectors(rows)


def test_vector_defined_cases(spark):
    rows = [(None, [1.0, 0.0]), (4, [2.0, 0.0]), (4, [2.0, 0.0]), (None, [0.0, 1.0]), (None, None)]
    out = [tuple(r) for r in neighbours.near_duplicates(vectors(spark, rows), "vec_id", "embedding").collect()]
    assert sorted(map(str, out)) == sorted(map(str, [
        (None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (None, 0, None, False), (None, 0, None, False)]))
    for none in ([], [(1, None)]):
        got = neighbours.near_duplicates(vectors(spark, none), "vec_id", "embedding").collect()
        assert [tuple(r) for r in got] == [(1, 0, 1, True)] * len(none)


def test_embedding_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op3_embedding_dedup"](spark, SF_SMALL).collect()) == brute_vectors(rows)


# --- MinHash -------------------------------------------------------------

def shingles(text):
    words = text.encode().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprint_query(spark):
    df = QUERIES["op10_minhash_fingerprint"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "ArrowEval", "MapIn", "Pandas"))
    rows, got = documents(spark), {r.doc_id: r for r in df.collect()}
    assert len(got) == len(rows)
    errors, prints = [], {}
    for k, (doc_id, text) in enumerate(rows):
        after, half, r = rows[(k + 1) % len(rows)].text, len(text) // 2, got[doc_id]
        edited = text[:len(text) - half] + after[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, after)]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    assert max(map(abs, errors)) < 0.16 and abs(np.mean(errors)) < 0.01


def bin_order(spark):
    """xxHash64 of (empty bin, filled bin), as Spark computes it."""
    pairs = spark.range(minhash.BINS ** 2).selectExpr(f"CAST(id DIV {minhash.BINS} AS INT) AS i", f"CAST(id % {minhash.BINS} AS INT) AS j")
    return {(r.i, r.j): r.h for r in pairs.select("i", "j", F.xxhash64("i", "j").alias("h")).collect()}


def brute_fingerprint(hashes, order):
    """Low bits of the densified bins of signed 64-bit shingle hashes."""
    bins = [None] * minhash.BINS
    for h in hashes:
        v = ((h & (2**64 - 1)) >> 1) | 1
        b = v >> minhash._BIN_SHIFT
        bins[b] = v if bins[b] is None else min(bins[b], v)
    filled, out = [j for j in range(minhash.BINS) if bins[j] is not None], []
    for i in range(minhash.BINS):
        tries = [i, *(minhash.probe(i, a) for a in range(minhash.ASKED)), min(filled, key=lambda j: (order[i, j], j))]
        out.append(next(bins[t] for t in tries if bins[t] is not None) >> 1 & (1 << minhash.BITS) - 1)
    return out


def test_fingerprint_equals_brute_force(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["ab", "cd", "Ef", "gh", "é"]) for _ in range(n)) for n in (1, 3, 5, 6, 12, 300, 3000)]
    df = minhash.with_fingerprint(spark.createDataFrame([(t,) for t in texts], "text string"), "text", "sig")
    order = bin_order(spark)
    for r in df.collect():
        words = r.text.split()
        parts = [words[i:i + 5] for i in range(len(words) - 4)] or [[" ".join(words)]]
        hashed = spark.createDataFrame([(p,) for p in parts], "w array<string>").select(
            F.xxhash64(*(F.get("w", F.lit(i)) for i in range(len(parts[0]))))).collect()
        want = brute_fingerprint([h[0] for h in hashed], order)
        got = [(v & (2**64 - 1)) >> (8 * k) & 255 for v in r.sig for k in range(8)]
        assert got == want


def test_fingerprint_defined_cases(spark):
    long = "very long text " * 20_000
    rows = [(1, None), (2, ""), (2, ""), (3, "a b"), (None, "last of all"), (4, long), (3, "tie of ids")]
    out = minhash.fingerprint_edits(frame(spark, rows)).select(
        "doc_id", "n_chars", "edited", minhash.as_text(F.col("sig")).alias("f"), minhash.likeness(F.col("sig"), F.col("next_sig")).alias("near")).collect()
    assert len(out) == len(rows)
    by = {(r.doc_id, r.n_chars): r for r in out}
    assert by[1, 0].f == "" and by[1, 0].near == 1.0 and by[1, 0].edited == ""
    assert by[4, len(long)].edited == long[:len(long) // 2] + "last of all"
    assert by[None, 11].edited == "last o"  # the first document follows, and it is empty
    assert minhash.fingerprint_edits(frame(spark, [])).count() == 0
    one = minhash.fingerprint_edits(frame(spark, [(5, "one two three")])).first()
    assert one.edited == "one two" + "one tw"


@pytest.mark.parametrize("n", [5, 8, 12, 20])
def test_short_texts_are_compared_as_well_as_long_ones(spark, n):
    rng = random.Random(n)
    rows = []
    for i in range(500):
        a = [f"w{rng.randrange(10**6)}" for _ in range(n + 4)]
        b = list(a)
        if i % 2:
            b[rng.randrange(len(b))] = "other"
        else:
            b = b[:rng.randint(5, len(b))] + [f"v{rng.randrange(10**6)}" for _ in range(rng.randint(0, 6))]
        rows.append((" ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    df = minhash.with_fingerprint(minhash.with_fingerprint(df, "a", "x"), "b", "y")
    errors = [r.near - jaccard(r.a, r.b) for r in df.select("a", "b", minhash.likeness(F.col("x"), F.col("y")).alias("near")).collect()]
    assert np.std(errors) < 0.05 and abs(np.mean(errors)) < 0.01


@pytest.mark.parametrize("per_range", [2, 5, 1000])
def test_next_rows_with_many_null_and_equal_ids(spark, per_range):
    rng = random.Random(3)
    rows = [(rng.choice([None, None, 7, i]), f"text {rng.randrange(25)}") for i in range(120)] + [(7, "same")] * 30 + [(None, "none")] * 30
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = minhash.with_next(df, "doc_id", ["text"], lambda d: d, per_range).select("doc_id", "text", "next_text").collect()
    tied = df.select("doc_id", "text", F.xxhash64("text").alias("tie")).collect()
    order = [(r.doc_id, r.text) for r in sorted(tied, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.tie))]
    want = [(*r, order[(i + 1) % len(order)][1]) for i, r in enumerate(order)]
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    sizes = [r.n for r in minhash._ranges(df, "doc_id", per_range).groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()]
    if per_range == 5:  # the largest groups of one id have over 60 rows
        assert max(sizes) <= 20 and len(sizes) > 12
