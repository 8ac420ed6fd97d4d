"""Queries of the training-data operators: thin bindings of each operator, with
its production parameters, to the whole driver table it is meant for."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import functions as F

from cartwheel.llm import (bpe, divergence, html_text, minhash, mixing, neighbours, packing, quality, secrets, simhash, spelling,
                           substrings, warc)
from cartwheel.llm.common import read_table
from cartwheel.session import ship_package

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op6_bpe_encode")
def op6_bpe_encode(spark, sf_dir):
    """Ids and decoding of every document, as digests."""
    docs = read_table(spark, sf_dir, "documents")
    return bpe.digests(bpe.encode_texts(docs, tokenizer_path(), F.col("doc_id"), F.col("text")))


@query("op4_quality_classifier")
def op4_quality_classifier(spark, sf_dir):
    """Quality score of every document; labels of the held-out fold are never read."""
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").where(~quality.held_out(F.col("doc_id")))
    model = quality.fit(docs, labels)
    scored = quality.score_texts(docs, model, F.col("doc_id"), F.col("text"))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op5_simhash_dedup")
def op5_simhash_dedup(spark, sf_dir):
    """Near-duplicate groups of every document by SimHash."""
    docs = read_table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs, F.col("doc_id"), F.col("text"))


@query("op7_secret_scan", secrets.scan_sql())
def op7_secret_scan(spark, sf_dir):
    """Secrets in every document."""
    docs = read_table(spark, sf_dir, "documents")
    found = secrets.scan(docs, F.col("text"), F.col("doc_id"))
    return found.select(
        "doc_id", *(secrets.count_of(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"))


OP9_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS digest FROM p),
m AS (SELECT digest, max(page_id) AS last FROM d WHERE n >= 1000 GROUP BY digest)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN d.page_id < m.last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id < m.last THEN m.last END AS refers_to
FROM d LEFT JOIN m ON d.digest = m.digest AND d.n >= 1000"""


@query("op9_warc_archive", OP9_SQL)
def op9_warc_archive(spark, sf_dir):
    """Every page written to and read back from dictionary-compressed archives."""
    pages = read_table(spark, sf_dir, "pages")
    return warc.archive_pages(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_html_extract")
def op8_html_extract(spark, sf_dir):
    """Main text of every page."""
    return html_text.extract(read_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op10_minhash_fingerprint")
def op10_minhash_fingerprint(spark, sf_dir):
    """Fingerprints of every document and of its edited text."""
    rows = minhash.fingerprint_edits(read_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        minhash.as_text(F.col("sig")).alias("fingerprint"), minhash.as_text(F.col("edited_sig")).alias("edited_fingerprint"),
        minhash.likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        minhash.likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))


OP2_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20),
windows AS (SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS k FROM places),
later AS (SELECT doc_id, p FROM (
  SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS i FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, COUNT(gone.i) AS n_removed,
  coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone.i IS NULL), '') AS text
  FROM words LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


@query("op2_substring_dedup", OP2_SQL)
def op2_substring_dedup(spark, sf_dir):
    """Repeated sequences of 20 words removed from every document."""
    kept = substrings.remove_repeats(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP3_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
       AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reached(vec_id, root) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT links.b, reached.root FROM reached JOIN links ON links.a = reached.vec_id),
parts AS (SELECT vec_id, MIN(root) AS component_id FROM reached GROUP BY vec_id)
SELECT vec_id, (SELECT COUNT(*) FROM links WHERE links.a = parts.vec_id) AS n_links, component_id,
       vec_id = component_id AS kept
FROM parts"""


@query("op3_embedding_dedup", OP3_SQL)
def op3_embedding_dedup(spark, sf_dir):
    """Near-duplicate groups of all embeddings."""
    return neighbours.near_duplicates(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


@query("op1_source_mixing", mixing.mix_sql())
def op1_source_mixing(spark, sf_dir):
    """Documents of a mix with target weights, one row for each use."""
    docs = read_table(spark, sf_dir, "documents")
    used = mixing.with_copies(docs, mixing.MIX, F.col("doc_id"), mixing.document_levels(), F.col("text"))
    return used.select(F.col("_key").alias("doc_id"), F.col("_domain").alias("domain"), F.col("_lang").alias("lang"),
                       F.col("_source").alias("source"), F.col("_tokens").alias("n_tokens"), F.col("_epoch").alias("epoch"))


@query("op11_packing")
def op11_packing(spark, sf_dir):
    """Every document's tokens in sequences of at most 2048."""
    docs = read_table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, F.col("doc_id"), F.col("text"), tokenizer_path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op12_source_divergence", divergence.audit_sql())
def op12_source_divergence(spark, sf_dir):
    """Distances between the sources of each language, and the terms that mark a source."""
    return divergence.audit(read_table(spark, sf_dir, "documents"), F.col("lang"), F.col("source"), F.col("text"))


@query("op13_spelling_variants", spelling.variants_sql())
def op13_spelling_variants(spark, sf_dir):
    """Words of all documents with the more frequent words that they misspell."""
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"))
