"""How far the sources of a language differ in their words.

The term counts come from a single pass over the texts: each task gathers postings
(terms with counts, by language and source) in memory until they fill it, then
spills them as a run sorted by term.  Runs are dealt to shards by a hash of
(language, term); inside a shard Spark's sort merges them, and one pass over the
merged rows adds the counts of a term and drops terms in too few documents.

A term that occurs in neither of two sources adds the same amount to their
distance whatever the term, so the sum over all V terms starts as V times that
amount.  Corrections are then streamed: for terms that one source has, from how
many terms it has of each count; for terms that both have, from the postings
themselves, added up in tiles of sources.  No pair of sources is emitted per term.

All arithmetic is exact in 64 bits, for up to 9 x 10^15 words of a language.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import null_to_empty
from cartwheel.session import checkpoint_dir, ship_package

MIN_DOCUMENTS = 10
TOP_TERMS = 10
# Entries (source and term) that a task holds before it spills a run, some 100 MB.
BLOCK_ENTRIES = 600_000
# Sources on a side of a tile, and tiles that a task holds (512 KB each).
TILE = 256
MAX_TILES = 64
# ASCII letters in lower case and bytes of other characters; the rest parts terms.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_TERM_SQL = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


# --- counts --------------------------------------------------------------

def terms(text: str) -> list[bytes]:
    """Terms of a text, in order, as UTF-8."""
    return text.encode().translate(_TERM_BYTES).split()


def _runs(limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of a block of documents, one run sorted by term for each block."""
    postings: dict[tuple, tuple[Counter, Counter]] = {}
    entries = 0
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            n, docs = postings.setdefault((lang, source), (Counter(), Counter()))
            entries -= len(n)
            found = terms(text)
            n.update(found)
            docs.update(set(found))
            entries += len(n)
            if entries >= limit:
                yield from _spill(postings)
                postings, entries = {}, 0
    yield from _spill(postings)


def _spill(postings: dict[tuple, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    groups = sorted(postings)
    sizes = [len(postings[g][0]) for g in groups]
    coded = pa.array((t for g in groups for t in postings[g][0]), pa.binary(), size=sum(sizes)).dictionary_encode()
    n = np.fromiter((x for g in groups for x in postings[g][0].values()), np.int64)
    docs = np.fromiter((postings[g][1][t] for g in groups for t in postings[g][0]), np.int64)
    alphabetic = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty_like(alphabetic)
    rank[alphabetic] = np.arange(len(alphabetic), dtype=rank.dtype)
    lang, source = (pa.array([g[i] for g in groups], pa.string()) for i in range(2))
    langs = sorted({g[0] for g in groups})
    group = np.repeat(np.arange(len(groups)), sizes)
    code = coded.indices.to_numpy()
    order = np.lexsort((group, rank[code], np.repeat([langs.index(g[0]) for g in groups], sizes)))
    for lo in range(0, len(order), 20_000):
        some = order[lo:lo + 20_000]
        yield pa.RecordBatch.from_arrays(
            [lang.take(pa.array(group[some])), coded.dictionary.take(pa.array(code[some])).cast(pa.string()), source.take(pa.array(group[some])),
             pa.array(n[some]), pa.array(docs[some])], names=["lang", "term", "source", "n", "docs"])


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Rows that differ from the row before in any of the columns."""
    first = np.zeros(len(columns[0]), bool)
    first[:1] = True
    for c in columns:
        first[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(first)


def _merged(min_docs: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (lang, term, source) to counts of the terms that enough of the
    language's documents have.  The last term of a batch waits for the next batch."""
    names = ["lang", "term", "source", "n", "n_lang"]

    def kept(columns: list[np.ndarray]) -> pa.RecordBatch:
        lang, term, source, n, docs = columns
        starts = _changes(lang, term)
        sizes = np.diff(np.append(starts, len(lang)))
        keep = np.repeat(np.add.reduceat(docs, starts) >= min_docs, sizes)
        n_lang = np.repeat(np.add.reduceat(n, starts), sizes)
        return pa.RecordBatch.from_arrays([pa.array(c[keep], pa.string()) for c in (lang, term, source)]
                                          + [pa.array(c[keep].astype(np.int64)) for c in (n, n_lang)], names=names)

    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        if held is not None:
            columns = [np.concatenate(pair) for pair in zip(held, columns)]
        starts = _changes(*columns[:3])
        columns = [c[starts] for c in columns[:3]] + [np.add.reduceat(c, starts) for c in columns[3:]]
        cut = _changes(columns[0], columns[1])[-1]
        held = [c[cut:] for c in columns]
        if cut:
            yield kept([c[:cut] for c in columns])
    if held is not None:
        yield kept(held)


def term_counts(docs: DataFrame, lang: Column, source: Column, text: Column, min_docs: int = MIN_DOCUMENTS,
                block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """``lang``, ``term``, ``source``, ``n`` (occurrences) and ``n_lang`` (in the whole
    language) of the terms that at least ``min_docs`` documents of the language have."""
    rows = docs.select(*(null_to_empty(c).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    runs = rows.mapInArrow(functools.partial(_runs, block_entries), "lang string, term string, source string, n bigint, docs bigint")
    shards = runs.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return shards.mapInArrow(functools.partial(_merged, min_docs), "lang string, term string, source string, n bigint, n_lang bigint")


# --- distances -----------------------------------------------------------

def share(n: Column, total: Column) -> Column:
    """``1 + floor(10^9 * (n + 2) / total)``, by long division in three steps of 10^3."""
    first = (n + F.lit(2)) * 1000
    second = (first % total) * 1000
    third = (second % total) * 1000
    whole = lambda a: F.call_function("div", a, total)
    return F.lit(1) + whole(first) * 1_000_000 + whole(second) * 1000 + whole(third)


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of a term, one row each (``lang``, ``p``: code, share and share of an
    absent term for each source), to partial sums of the corrections for two sources
    that both have a term."""
    tiles: dict[tuple, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, i, j), tile in tiles.items():
            a, b = np.nonzero(tile)
            upper = i * TILE + a < j * TILE + b
            a, b = a[upper], b[upper]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(a), pa.string()), pa.array(i * TILE + a), pa.array(j * TILE + b), pa.array(tile[a, b])],
                names=["lang", "a", "b", "value"])
        tiles.clear()

    for batch in batches:
        postings = batch.column("p")
        ends = postings.offsets.to_numpy()
        code, p, zero = (f.to_numpy(zero_copy_only=False).astype(np.int64) for f in postings.values.flatten())
        for lang, lo, hi in zip(batch.column("lang").to_pylist(), ends[:-1], ends[1:]):
            order = lo + np.argsort(code[lo:hi])
            cuts = _changes(code[order] // TILE)
            blocks = np.split(order, cuts[1:])
            for x, left in enumerate(blocks):
                for right in blocks[x:]:
                    pl, pr, zl, zr = p[left][:, None], p[right][None], zero[left][:, None], zero[right][None]
                    key = (lang, int(code[left[0]]) // TILE, int(code[right[0]]) // TILE)
                    if key not in tiles:
                        if len(tiles) >= MAX_TILES:
                            yield from flush()
                        tiles[key] = np.zeros((TILE, TILE), np.int64)
                    tiles[key][np.ix_(code[left] % TILE, code[right] % TILE)] += (
                        _gap(pl, pr) - _gap(pl, zr) - _gap(zl, pr) + _gap(zl, zr))
    yield from flush()


def audit(docs: DataFrame, lang: Column, source: Column, text: Column, min_docs: int = MIN_DOCUMENTS,
          top: int = TOP_TERMS) -> DataFrame:
    """For each (language, source): its distance to every other source of the language
    (``part`` ``pair``) and the ``top`` terms that it has above its language's share
    (``part`` ``term``), as ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Null languages, sources and texts count as empty; texts of any length are taken
    whole, and repeated rows count as often as they occur.  A group without terms
    takes part with zero counts; a language without kept terms has distances 0 and no
    terms.  Equal values are ranked by the item's UTF-8 bytes.  Other columns are not
    read, whatever their names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    checkpoint_dir(spark)
    counts = term_counts(docs, lang, source, text, min_docs).checkpoint()
    groups = _groups(docs.select(null_to_empty(lang).alias("lang"), null_to_empty(source).alias("source")), counts).checkpoint()
    rows = counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total")))
    return _pairs(rows, groups).unionByName(_terms(rows, top))


def _groups(members: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``code`` (number in the language), ``v``, ``total`` and
    ``lang_total`` (the divisors of shares), ``zero`` (share of an absent term)."""
    seen = members.distinct()
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    sizes = counts.groupBy("lang", "term").agg(F.max("n_lang").alias("n_lang")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("n_lang").alias("n_lang"))
    found = seen.join(sums, ["lang", "source"], "left").join(sizes, "lang", "left")
    v = F.coalesce("v", F.lit(0))
    # Without kept terms there are no shares; the divisor is then null.
    total = F.coalesce("n", F.lit(0)) + F.col("v") * 2
    return found.select(
        "lang", "source", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("bigint").alias("code"),
        v.alias("v"), total.alias("total"), (F.col("n_lang") + F.col("v") * 2).alias("lang_total"),
        share(F.lit(0).cast("bigint"), total).alias("zero"))


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    side = lambda letter: groups.select("lang", F.col("code").alias(letter), F.col("zero").alias(f"{letter}_zero"))
    base = side("a").join(side("b").join(groups.select("lang", "v").distinct(), "lang"), "lang").where("a < b").select(
        "lang", "a", "b", F.coalesce(F.col("v") * gap(F.col("a_zero"), F.col("b_zero")), F.lit(0)).alias("value"))
    # Terms that source a has: how many of each count, against b's share of absent terms.
    repeats = rows.groupBy("lang", F.col("code").alias("a"), "p", F.col("zero").alias("a_zero")).agg(F.count(F.lit(1)).alias("m"))
    once = repeats.join(side("b"), "lang").where("a <> b").select(
        "lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
        (F.col("m") * (gap(F.col("p"), F.col("b_zero")) - gap(F.col("a_zero"), F.col("b_zero")))).alias("value")).groupBy(
        "lang", "a", "b").agg(F.sum("value").alias("value"))
    postings = rows.groupBy("lang", "term").agg(F.collect_list(F.struct("code", "p", "zero")).alias("p")).select("lang", "p")
    twice = postings.mapInArrow(_tiles, "lang string, a bigint, b bigint, value bigint")
    sums = base.unionByName(once).unionByName(twice).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    name = lambda letter, column: groups.select("lang", F.col("code").alias(letter), F.col("source").alias(column))
    named = both.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"])
    return _ranked(named.select("lang", "source", F.lit("pair").alias("part"), "item", "value"))


def _terms(rows: DataFrame, top: int) -> DataFrame:
    q = share(F.col("n_lang"), F.col("lang_total"))
    above = rows.withColumn("q", q).where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    return _ranked(above).where(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit_sql(min_docs: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> str:
    """DuckDB SQL for the registered query."""
    p = "1 + (1000000000::HUGEINT * ({n} + 2)) // ({total} + 2 * v)"
    f = "((p - q) * (p - q)) // (p + q)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{_TERM_SQL}') AS w FROM documents),
groups AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n_lang FROM o GROUP BY ALL HAVING count(DISTINCT r) >= {min_docs}),
langs AS (SELECT lang, count(*) AS v, sum(n_lang) AS total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {p.format(n="coalesce(c.n, 0)", total="coalesce(s.total, 0)")} AS p,
    {p.format(n="k.n_lang", total="l.total")} AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
gaps AS (SELECT a.lang, a.source, b.source AS item, sum({f}) AS value
  FROM (SELECT lang, source, term, p FROM shares) a JOIN (SELECT lang, source, term, p AS q FROM shares) b
  ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(gaps.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gaps ON gaps.lang = a.lang AND gaps.source = a.source AND gaps.item = b.source
  UNION ALL SELECT lang, source, 'term', term, {f} FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM rows)
WHERE part = 'pair' OR rank <= {top}"""
