"""From raw documents to token ids, in five stages.

Each stage takes the rows that its predecessor kept, written as Parquet and read
again, and returns a DataFrame.  All but the last return the columns of
``documents`` (and any further columns the input has).

1. ``quality_classifier``: documents that score below the threshold go.
2. ``simhash_dedup``: one document of each near-duplicate group stays.
3. ``secret_scan``: secrets in texts are replaced; ``n_chars`` follows the text.
4. ``source_mixing``: documents are used as often as the target weights ask.
5. ``bpe_encode``: each text as token ids.

Defined cases hold for every stage: null texts count as empty, null ids and
repeated rows pass through as the operators say, extra columns are kept whatever
their names, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import bpe, mixing, quality, secrets, simhash
from cartwheel.llm.catalog import tokenizer_path
from cartwheel.llm.common import read_table
from cartwheel.session import scratch_path, ship_package

QUALITY_THRESHOLD = 0.3

# No SQL engine expresses the classifier or the encoder; the stages are tested
# against brute force instead.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose quality score reaches the threshold."""
    labels = read_table(spark, sf_dir, "labels").where(~quality.held_out(F.col("doc_id")))
    return quality.accept(docs, quality.fit(docs, labels), "text", QUALITY_THRESHOLD)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each near-duplicate group."""
    return simhash.deduplicate(docs, "doc_id", "text")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; documents without secrets stay as they are."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    found = secrets.scan(docs.select(row), F.col("row.text"), F.col("row"))
    text = secrets.redacted(F.col("row.text"), F.col("spans"))
    clean = found.select("row", F.size("spans").alias("n_spans"), text.alias("clean_text"))
    changed = {"text": F.col("clean_text"), "n_chars": F.when(F.col("n_spans") > 0, F.length("clean_text").cast(
        docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return clean.select(*((changed[c] if changed.get(c) is not None else F.col(f"row.`{c}`")).alias(c)
                          for c in docs.columns))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix uses it (not at all, or once for each epoch)."""
    used = mixing.with_copies(docs, mixing.MIX, F.col("doc_id"), mixing.document_levels(), F.col("text"))
    return used.select("_row.*")


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of each row's text, with counts and digests."""
    encoded = bpe.encode_texts(docs, tokenizer_path(), F.col("doc_id"), F.col("text"))
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("bpe_encode", bpe_encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet to
    the shared scratch folder and read again by the next."""
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
