"""Divergence of sources: counts, shares, distances, defined cases."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import divergence

COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def brute(rows, min_docs=10, top=10):
    """The audit from its definition: every term of every pair."""
    found = []
    rows = [tuple(x or "" for x in r) for r in rows]
    for lang in {r[0] for r in rows}:
        groups, docs = {}, Counter()
        for _, source, text in (r for r in rows if r[0] == lang):
            own = Counter("".join(c.lower() if "A" <= c <= "Z" else c if c.isascii() and c.islower() or ord(c) > 127 else " "
                                  for c in text).split(" "))
            own.pop("", None)
            docs.update(own.keys())
            groups.setdefault(source, Counter()).update(own)
        kept = [t for t, n in docs.items() if n >= min_docs]
        everything = sum(groups.values(), Counter())

        def shares(counts):
            total = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // total for t in kept}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        p, q = {s: shares(c) for s, c in groups.items()}, shares(everything)
        for s in groups:
            pairs = [(t, sum(gap(p[s][k], p[t][k]) for k in kept)) for t in groups if t != s]
            terms = [(k, gap(p[s][k], q[k])) for k in kept if groups[s][k] > 0 and p[s][k] > q[k]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                found += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(items, 1)
                          if part == "pair" or i <= top]
    return sorted(found)


def audited(spark, rows, schema="lang string, source string, text string", **kw):
    docs = spark.createDataFrame(rows, schema)
    out = divergence.audit(docs, F.col("lang"), F.col("source"), F.col("text"), **kw)
    assert tuple(out.columns) == COLUMNS
    return sorted(tuple(r) for r in out.collect())


def sample(seed, n=400, sources=9):
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in ("kal", "Mor", "tüx", "é") for b in "abcdefghijklmnopqrstuvwxyz"]
    rows = []
    for _ in range(n):
        source = min(int(rnd.expovariate(0.4)), sources - 1)
        some = rnd.sample(words, 60)[source:source + 30] + words[:3]
        rows.append((rnd.choice(["en", "en", "de"]), f"s{source}", " ".join(rnd.choices(some, k=rnd.randint(0, 25)))))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_audit_equals_the_definition(spark, seed):
    rows = sample(seed)
    assert audited(spark, rows) == brute(rows)


def test_tiles_smaller_than_the_sources(spark, monkeypatch):
    rows = sample(9, 300, 12)
    by_batch = spark.createDataFrame(rows, "lang string, source string, text string")
    counts = divergence.term_counts(by_batch, F.col("lang"), F.col("source"), F.col("text"))
    groups = divergence._groups(by_batch.select("lang", "source"), counts)
    joined = counts.join(groups, ["lang", "source"]).withColumn("p", divergence.share(F.col("n"), F.col("total")))
    postings = joined.groupBy("lang", "term").agg(F.collect_list(F.struct("code", "p", "zero")).alias("p")).select("lang", "p").toArrow()
    whole = {}
    for batch in divergence._tiles(iter(postings.to_batches())):
        for r in batch.to_pylist():
            whole[r["lang"], r["a"], r["b"]] = whole.get((r["lang"], r["a"], r["b"]), 0) + r["value"]
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "MAX_TILES", 2)
    cut = {}
    for batch in divergence._tiles(iter(postings.to_batches(max_chunksize=7))):
        for r in batch.to_pylist():
            cut[r["lang"], r["a"], r["b"]] = cut.get((r["lang"], r["a"], r["b"]), 0) + r["value"]
    assert whole == {k: v for k, v in cut.items() if v} | {k: 0 for k, v in whole.items() if not v}


def test_blocks_and_batches_do_not_change_counts():
    rows = sample(4, 200)
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["lang", "source", "text"])
    found = []
    for limit in (10, 300, 10**6):
        runs = list(divergence._runs(limit, iter([batch])))
        for run in runs:
            terms = [(r["lang"], r["term"].encode()) for r in run.to_pylist()]
            assert terms == sorted(terms)
        table = pa.Table.from_batches(runs).sort_by([("lang", "ascending"), ("term", "ascending"), ("source", "ascending")])
        for size in (1, 5, 10_000):
            merged = list(divergence._merged(10, iter(table.combine_chunks().to_batches(max_chunksize=size))))
            found.append(sorted(tuple(r.values()) for b in merged for r in b.to_pylist()))
    assert found[0] and all(f == found[0] for f in found)


def test_terms_equal_the_pattern():
    text = "Ab-cD éÉ_x\x00y`z{ü}~\x7f\U0001f600k 12 ÀB"
    want = [t.encode() for t in re.findall(divergence._TERM_SQL, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))]
    assert divergence.terms(text) == want


def test_shares_are_exact_beyond_64_bit_products(spark):
    cases = [(0, 4), (7, 13), (10**10, 3 * 10**10 + 1), (8 * 10**15, 9 * 10**15 - 7), (0, 9 * 10**15)]
    out = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(cases)], "i int, n bigint, t bigint").orderBy("i").select(
        divergence.share(F.col("n"), F.col("t")).alias("p")).collect()
    assert [r.p for r in out] == [1 + 10**9 * (n + 2) // t for n, t in cases]


def test_defined_cases(spark):
    word = "alpha beta"
    rows = [(None, None, word, 1)] * 12 + [("", "a", None, 2), ("", "b", "", 2), ("en", "x", "alone", 3), ("en", None, "gone", 3)]
    rows += [("de", "hot", "gamma " * 20_000 + word, 4)] * 11 + [("de", "small", "beta", 4)] * 3
    got = audited(spark, rows, "lang string, source string, text string, term int")
    assert got == brute([r[:3] for r in rows])
    assert ("en", "x", "pair", "", 0, 1) in got and ("", "a", "pair", "b", 0, 2) in got
    assert audited(spark, []) == []
    assert len([r for r in audited(spark, rows, "lang string, source string, text string, n int", top=1) if r[2] == "term"]) == len(
        {r[:2] for r in got if r[2] == "term"})
