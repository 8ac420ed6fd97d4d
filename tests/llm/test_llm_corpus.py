"""Classifier, mixing and the whole pipeline."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartwheel.llm import mixing, quality
from cartwheel.llm.catalog import QUERIES
from conftest import SF_ORACLE, SF_SMALL


# --- quality -------------------------------------------------------------

def test_classifier_on_the_held_out_fold(spark):
    out = QUERIES["op4_quality_classifier"](spark, SF_ORACLE).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").count()
    assert len(out) == docs and out.score.between(0, 1).all()
    assert (out.predicted == (out.score >= 0.3)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in out.held_out.items())
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").toPandas().set_index("doc_id")
    both = out.join(labels, how="inner")
    held = both[both.held_out]
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert (good.values[:, None] > bad.values[None, :]).mean() > 0.9
    assert (held.predicted == held.quality).mean() > 0.9
    assert held[held.quality == 1].predicted.mean() > 0.97


def test_held_out_labels_are_never_read(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    held = quality.held_out(F.col("doc_id"))
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit(docs, labels.where(~held)) == quality.fit(docs, flipped.where(~held))


def test_sample_has_one_text_for_each_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(40)] + [(2, "b"), (2, "b"), (3, "c"), (4, None)],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "doc_id bigint, quality int")
    want = min((f"text {i}" for i in range(40)), key=lambda t: hashlib.md5(t.encode()).hexdigest())
    for given in (docs, docs.orderBy(F.desc("text")).repartition(7)):
        assert sorted(quality.labelled_sample(given, labels, rows=5)) == [("b", 0), ("c", 1), (want, 1)]


def test_classifier_defined_cases(spark):
    rows = [(i, f"good words {i} of plain prose " * 5) for i in range(60)] + [(100 + i, f"%%% ### {i} &&& $$$ " * 8) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i, _ in rows] + [(5, 0, 0), (6, None, 0), (None, 1, 0), (999, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    model = quality.fit(docs, labels)
    tests = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "good words of plain prose", 0.1), (3, "%%% ### &&&" * 30_000, 0.2),
                                   (4, "good words", 0.0), (4, "good words", 0.0)], "doc_id bigint, text string, score double")
    out = quality.score_texts(tests, model, F.col("doc_id"), F.col("text")).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r.score for r in out}
    assert by[1] == by[2] and by[3] < 0.5 < by[None]
    none = quality.fit(docs, labels.where("quality = 1"))
    assert {r.score for r in quality.score_texts(tests, none, F.col("doc_id"), F.col("text")).collect()} == {1.0}
    empty = quality.fit(docs.limit(0), labels.limit(0))
    assert empty.prior == 0.5 and quality.score_texts(tests.limit(0), empty, F.col("doc_id"), F.col("text")).count() == 0
    kept = quality.accept(tests, model, "text", 0.3)
    assert kept.columns == tests.columns and {r.doc_id for r in kept.collect()} >= {None, 4}


# --- mixing --------------------------------------------------------------

def brute_fill(budget, children):
    """Water-filling by rounds: {name: (weight, capacity)} to {name: share}."""
    got, left = {}, dict(children)
    while left:
        total = sum(w for w, _ in left.values())
        full = {n for n, (w, c) in left.items() if c * total <= budget * w}
        if not full:
            return got | {n: budget * w / total for n, (w, _) in left.items()}
        for n in full:
            got[n] = left.pop(n)[1]
            budget -= got[n]
    return got


def test_budgets_go_to_siblings_before_ancestors(spark):
    mix = mixing.Mix(weights={"domain": {"a": 1, "b": 1, "z": 0}, "lang": {"en": 3, "de": 1}}, max_epochs=2)
    leaves = [("a", "en", "s1", 100), ("a", "en", "s2", 5), ("a", "de", "s1", 1000), ("b", "en", "s1", 3000), ("b", "de", "s1", 10),
              ("z", "en", "s1", 500), ("b", "de", "s2", 0)]
    out = mixing.leaf_budgets(spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint"), mix)
    got = {(r.domain, r.lang, r.source): r for r in out.collect()}
    live = [x for x in leaves if x[0] != "z"]
    cap = lambda *key: sum(2 * t for *k, t in live if tuple(k[:len(key)]) == key)
    domains = brute_fill(min(sum(x[3] for x in leaves), cap()), {d: (1, cap(d)) for d in "ab"})
    for d in "ab":
        langs = brute_fill(domains[d], {x: (w, cap(d, x)) for x, w in (("en", 3), ("de", 1))})
        for lang, share in langs.items():
            for s, want in brute_fill(share, {k[2]: (1, 2 * k[3]) for k in live if k[:2] == (d, lang)}).items():
                r = got[d, lang, s]
                assert abs(r.budget - want) <= 3
                assert r.epochs == (r.budget // r.tokens if r.tokens else 0) and r.rest == r.budget - r.epochs * r.tokens
    assert ("z", "en", "s1") not in got
    # English of domain a is short: German of a is filled first, and only then b gets more than its half.
    assert got["a", "en", "s1"].budget == 200 and got["a", "de", "s1"].budget == 2000


def test_mix_defined_cases(spark):
    rows = [(1, "a b c", None, None, 5, 1), (2, None, "en", "src1", 5, 1), (None, "d e", "en", "src1", 5, 1), (3, "x " * 50_000, "en", "src2", 5, 1),
            (4, "r s", "de", "src3", 5, 1), (4, "r s", "de", "src3", 5, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, epoch int, tokens int")
    out = mixing.with_copies(docs, mixing.MIX, F.col("doc_id"), mixing.document_levels(), F.col("text"))
    back = out.select("_row.*", "_epoch")
    assert back.columns[:-1] == docs.columns
    got = back.collect()
    assert all(0 <= r._epoch < mixing.MIX.max_epochs for r in got)
    uses = {}
    for r in got:
        uses[r.doc_id, r._epoch] = uses.get((r.doc_id, r._epoch), 0) + 1
    assert all(n == 2 for (i, _), n in uses.items() if i == 4)  # rows that share an id go together
    assert mixing.with_copies(docs.limit(0), mixing.MIX, F.col("doc_id"), mixing.document_levels(), F.col("text")).count() == 0


def test_mix_follows_the_targets(spark):
    out = QUERIES["op1_source_mixing"](spark, SF_SMALL).groupBy("domain").agg(F.sum("n_tokens").alias("t")).collect()
    total = sum(r.t for r in out)
    for r in out:
        assert abs(r.t / total - mixing.MIX.weights["domain"][r.domain] / 1000) < 0.1
    assert {r.epoch for r in QUERIES["op1_source_mixing"](spark, SF_SMALL).select("epoch").distinct().collect()} <= set(range(4))


# --- pipeline ------------------------------------------------------------

@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
    return dict(out)


def test_pipeline_stages_by_brute_force(spark, stages):
    from test_llm_duplicates import brute_groups, brute_simhash
    from test_llm_texts import brute_base, brute_entropy

    columns = stages["documents"].columns
    assert all(stages[n].columns == columns for n, _ in corpus_pipeline.STAGES[:-1])
    read = lambda n: {r.doc_id: r for r in stages[n].collect()}
    docs, good, one, clean = (read(n) for n in ("documents", "quality_classifier", "simhash_dedup", "secret_scan"))
    scores = {r.doc_id: r.score for r in QUERIES["op4_quality_classifier"](spark, SF_SMALL).collect()}
    assert set(good) == {i for i, s in scores.items() if s >= corpus_pipeline.QUALITY_THRESHOLD} and all(good[i] == docs[i] for i in good)
    ids = sorted(good)
    groups = brute_groups([brute_simhash(good[i].text) for i in ids], ids)
    assert set(one) == set(groups) and all(one[i] == docs[i] for i in one)
    assert set(clean) == set(one)
    for i, r in clean.items():
        text, at, want = one[i].text, 0, ""
        for a, _, e in sorted(brute_base(text) + brute_entropy(text)):
            if a >= at:
                want += text[at:a] + "[REDACTED]"
            at = max(at, e)
        assert r.text == want + text[at:]
        assert r.n_chars == (len(r.text) if r.text != text else one[i].n_chars)
    mixed = stages["source_mixing"].collect()
    assert {r.doc_id for r in mixed} <= set(clean) and all(r == clean[r.doc_id] for r in mixed)
    encoded = stages["bpe_encode"].collect()
    assert len(encoded) == len(mixed)


def test_pipeline_run_equals_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.exceptAll(stages["bpe_encode"]).count() == 0 and got.count() == stages["bpe_encode"].count()


def test_pipeline_defined_cases(spark):
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(5)
    extra = base.unionByName(spark.createDataFrame(
        [(None, None, None, None, None), (900, "", "en", "src1", 0), (900, "", "en", "src1", 0), (901, None, None, "x", None),
         (902, "token=abcdefghijklmnop " * 3000, "en", "src2", None)], base.schema))
    for row in ("row", "fp", "_key", "spans"):
        extra = extra.withColumn(row, F.lit(1))
    for docs in (extra, extra.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            assert out.count() == out.count()
            if name != "bpe_encode":
                assert out.columns == docs.columns, name
