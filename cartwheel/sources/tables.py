"""Readers for the driver's parquet tables and their binding to the reference's
interaction / review / mapping / basket shapes.

Bindings are plain projections and joins, so Catalyst pushes filters and
column pruning down to the parquet scans of the underlying tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_csv(spark: SparkSession, path: str, schema=None, header: bool = True) -> DataFrame:
    """CSV scan with a declared schema (inference only when none is given)."""
    reader = spark.read.option("header", header)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a DataFrame (lazy parquet scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def session_key(user: Column, ts: Column) -> Column:
    """``user_session`` for the event table: user and calendar day."""
    return F.concat(user.cast("string"), F.lit("|"), F.to_date(ts).cast("string"))


def interactions(spark: SparkSession, sf_dir: str, with_attributes: bool = True) -> DataFrame:
    """Shop events in the reference's interaction shape.

    ``click`` plays the role of ``cart``; product attributes come from ``part``.
    """
    ev = table(spark, sf_dir, "events")
    df = ev.select(
        F.col("event_id"),
        F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == "click", F.lit("cart"))
         .otherwise(F.col("event_type")).alias("event_type"),
        F.get_json_object("props", "$.k").try_cast("int").alias("product_id"),
        F.col("value").alias("price"),
        F.col("user_id"),
        session_key(F.col("user_id"), F.col("ts")).alias("user_session"),
    )
    if not with_attributes:
        return df
    # Shop feeds lack some category codes: parts of every fifth size have none.
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("_pk"),
        F.when(F.col("p_size") % 5 != 0, F.col("p_type")).alias("category_code"),
        F.col("p_brand").alias("brand"))
    # Size is left to AQE/autoBroadcastJoinThreshold: part grows with the data.
    return (df.join(part, df.product_id == part._pk, "left").drop("_pk"))


def labelled(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """Rows of documents with their labels, once for each label (unlabelled ones once)."""
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (+ labels) in the reference's review shape; numerics and dates stay
    strings.  As in a shop export, some are malformed: German prices carry a
    currency, French dates are missing, and short texts have no title."""
    docs = table(spark, sf_dir, "documents")
    title = F.substring_index(F.col("text"), "\n", 1)
    return (labelled(spark, sf_dir, docs).select(
        F.col("doc_id").alias("review_id"),
        F.col("doc_id").alias("product_id"),
        F.col("source").alias("brand_name"),
        F.when(F.col("n_chars") >= 400, title).alias("review_title"),
        F.col("text").alias("review_text"),
        F.col("lang"),
        title.alias("product_title"),
        F.col("quality").cast("string").alias("product_rating"),
        F.col("toxic").cast("string").alias("review_label"),
        F.col("n_chars").cast("string").alias("product_rating_count"),
        F.when(F.col("lang") == "de", F.concat(F.lit("EUR "), F.col("n_chars").cast("string")))
         .otherwise(F.concat(F.floor(F.col("n_chars") / 100).cast("string"), F.lit("."),
                             F.lpad((F.col("n_chars") % 100).cast("string"), 2, "0"))).alias("price"),
        F.when(F.col("lang") == "fr", F.lit("n/a")).otherwise(F.concat(
            F.date_add(F.lit("2023-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).cast("string"),
            F.lit(" 12:30:00"))).alias("review_date"),
    ))


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review product ↔ event product bridge derived from the documents."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        (F.col("doc_id") % 100).cast("int").alias("product_id_events"),
        F.col("doc_id").alias("product_id_reviews"),
    )


def order_baskets(spark: SparkSession, sf_dir: str, item: str = "part") -> DataFrame:
    """Purchase triples ``(basket, item, qty)`` from lineitem.

    ``item='part'`` uses ``l_partkey``; ``item='brand'`` maps parts to ``p_brand``.
    """
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("basket"), F.col("l_partkey"), F.col("l_quantity").alias("qty"))
    if item == "part":
        return li.select("basket", F.col("l_partkey").alias("item"), "qty")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey"), F.col("p_brand").alias("item"))
    return li.join(part, li.l_partkey == part.p_partkey, "inner").select("basket", "item", "qty")
