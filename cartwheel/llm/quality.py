"""Quality classifier by compression.

Two zstandard dictionaries are built, one from texts labelled good and one from
texts labelled bad.  A text is compressed with each; the difference of the two
sizes, normalised by the raw size and by the compressed sizes, tells which
corpus explains the text better.  A logistic curve fitted on labelled texts
that no dictionary has seen turns it into a calibrated probability.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import null_to_empty, per_text, per_worker
from cartwheel.session import ship_package

# Bounds of the sample that the model is fitted on (rows of each label, and
# characters of a row); scoring has no bounds.
SAMPLE_ROWS = 1500
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 112_640
LEVEL = 3


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the calibration; without dictionaries a constant."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    prior: float


class Scorer:
    def __init__(self, model: Model, level: int = LEVEL):
        self.model = model
        if model.good:
            self.good, self.bad = _compressor(model.good, level), _compressor(model.bad, level)

    def features(self, text: str) -> tuple[float, ...]:
        raw = text.encode("utf-8")
        good, bad = len(self.good(raw)), len(self.bad(raw))
        both = good + bad
        return 1.0, (bad - good) / (len(raw) + 1), (bad - good) / (both + 1), math.log((both + 1) / (len(raw) + 1))

    def score(self, text: str) -> float:
        if not self.model.good:
            return self.model.prior
        z = sum(w * x for w, x in zip(self.model.weights, self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z))))


def _compressor(dictionary: bytes, level: int):
    import zstandard

    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=known, level=level, write_content_size=False,
                                    write_checksum=False, write_dict_id=False).compress


def _dictionary(texts: list[str], size: int) -> bytes:
    """A trained dictionary, or the texts themselves where they are too few to train one."""
    import zstandard

    samples = [t.encode("utf-8") for t in texts if t]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[:size]


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS,
                    chars: int = SAMPLE_CHARS, seed: int = 0) -> list[tuple[str, int]]:
    """At most ``rows`` texts of each label, chosen by a seeded hash of their id.

    Rows are picked from the narrow label table first, so the semi-join's other
    side has at most ``2 * rows`` rows and is safe to broadcast.  An id with
    several texts gives the one with the least hash.  Ids with contradicting
    labels, null labels and texts over ``chars`` are left out.
    """
    known = (labels.groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi"))
             .where(F.col("lo").isin(0, 1) & (F.col("lo") == F.col("hi")) & F.col("doc_id").isNotNull())
             .select("doc_id", F.col("lo").alias("quality"),
                     F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))).alias("order")))
    picked = known.where("quality = 1").orderBy("order").limit(rows).unionByName(
        known.where("quality = 0").orderBy("order").limit(rows))
    found = (docs.join(F.broadcast(picked), "doc_id")
             .where(F.col("text").isNotNull() & (F.length("text").between(1, chars)))
             .groupBy("order", "quality")
             .agg(F.min_by("text", F.struct(F.md5(F.col("text").cast("binary")), "text")).alias("text")))
    # The bounded sample: its order is the seeded hash, never the row order.
    return [(r.text, r.quality) for r in sorted(found.collect(), key=lambda r: (r.order, r.text))]


def fit(docs: DataFrame, labels: DataFrame, dictionary_bytes: int = DICTIONARY_BYTES,
        rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model:
    """Fit on a bounded sample of labelled texts (``rows`` of each label).

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and
    ``quality`` (1 good, 0 bad).  Every second sampled text builds a dictionary,
    the others fit the curve; its intercept is moved to the share of good rows
    among all labels.  With fewer than 8 texts of a label there is no model: each
    text gets the share of good labels (0.5 without labels) as its score.
    """
    ship_package(docs.sparkSession)
    counts = labels.agg(F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)).first()
    n_good, n_bad = counts[0] or 0, counts[1] or 0
    prior = n_good / (n_good + n_bad) if n_good + n_bad else 0.5
    sample = labelled_sample(docs.select("doc_id", "text"), labels.select("doc_id", "quality"), rows, chars)
    good, bad = [t for t, q in sample if q == 1], [t for t, q in sample if q == 0]
    if min(len(good), len(bad)) < 8:
        return Model(b"", b"", (), prior)
    raw = Model(_dictionary(good[::2], dictionary_bytes), _dictionary(bad[::2], dictionary_bytes), (), prior)
    scorer = Scorer(raw)
    x = np.array([scorer.features(t) for t in good[1::2] + bad[1::2]])
    y = np.array([1.0] * len(good[1::2]) + [0.0] * len(bad[1::2]))
    # Each label weighs as much as it does among all labels.
    weight = np.where(y == 1, prior / max(y.sum(), 1), (1 - prior) / max((1 - y).sum(), 1)) * len(y)
    return Model(raw.good, raw.bad, tuple(_logistic(x, y, weight)), prior)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> list[float]:
    """Weighted logistic regression by Newton steps on scaled features."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[0] = 1.0
    mean = x.mean(axis=0)
    mean[0] = 0.0
    z, w = (x - mean) / scale, np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (p - y)) + ridge * len(y) * w
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * len(y) * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    out = w / scale
    out[0] -= float(out[1:] @ mean[1:])
    return [float(v) for v in out]


def score_texts(df: DataFrame, model: Model, key: Column, text: Column, key_type: str = "bigint") -> DataFrame:
    """Rows ``(doc_id, score double)``, one for each input row.

    The whole text is scored; a null text counts as empty and gets the score of
    the empty text.  Repeated rows and null keys are scored like any other row;
    other columns are ignored.  An empty table gives an empty result.
    """
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    @per_worker
    def start():
        scorer = Scorer(shared.value)
        return lambda doc_id, body: (doc_id, scorer.score(body))

    return per_text(df, [key.alias("doc_id"), null_to_empty(text).alias("text")], start,
                    f"doc_id {key_type}, score double")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a document is outside the rows that labels may be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def accept(df: DataFrame, model: Model, text: str, threshold: float) -> DataFrame:
    """The rows of ``df`` whose ``text`` scores ``threshold`` or more, all columns unchanged."""
    import pyarrow as pa

    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                good = [scorer.score(t or "") >= threshold for t in part.column(text).to_pylist()]
                yield part.filter(pa.array(good, pa.bool_()))

    return df.mapInArrow(run, df.schema)
