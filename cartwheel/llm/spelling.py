"""Spelling variants: words one edit apart, found by PartEnum signatures.

A word's letters, numbered by occurrence, are a set (``banana``: a1 a2 a3 b1 n1
n2), that is, a binary vector.  One replaced letter changes two elements, an
inserted one changes one, so words one edit apart are at Hamming distance two
(equal lengths) or one (lengths that differ by one).  PartEnum cuts the elements
into parts and enumerates the choices of parts that two such words must share
whole: all but two of ``SAME_PARTS``, all but one of ``CROSS_PARTS``.  As the edit
lies in one half of the word, the other half must be equal too; each signature is
taken once with the first and once with the second half.

Words meet in an equi-join on signatures and are verified by their edit distance.
Signatures that more than ``GROUP_LIMIT`` words share (anagrams of one another, for
example) are left out of that join: the words that have such a signature meet by
their spelling without one letter instead, where a group cannot grow beyond the
alphabet times the word's length.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import null_to_empty
from cartwheel.session import checkpoint_dir, scratch_path, ship_package

MIN_LENGTH = 7
MIN_COUNT = 2
# A word's form must be this many times as frequent.
FORM_RATIO = 10
SAME_PARTS, CROSS_PARTS = 3, 2
GROUP_LIMIT = 1000
# A table of hot signatures is broadcast up to this many (8 bytes each).
BROADCAST_KEYS = 1_000_000
# Words that a task holds before it passes their counts on.
BLOCK_WORDS = 400_000
# One occurrence set in DROP_ONE_IN, chosen by a checksum, loses a letter.
DROP_ONE_IN = 31
# Latin-1: letters, A-Z in lower case; everything else parts words.
_LETTER_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))


# --- words ---------------------------------------------------------------

def spellings(doc_id: str, text: str, min_length: int) -> Iterator[tuple[bytes, int]]:
    """Words of one document (Latin-1) with their counts, after the lost letters."""
    prefix = zlib.crc32(f"{doc_id}:".encode())
    # One byte for each code point; what Latin-1 lacks becomes '?', which is no letter.
    words = text.encode("latin-1", "replace").translate(_LETTER_BYTES).split()
    for word, n in Counter(w for w in words if len(w) >= min_length).items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
        if h % DROP_ONE_IN == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
            if len(word) < min_length:
                continue
        yield word, n


def _counted(min_length: int, limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[bytes, int] = {}

    def passed_on() -> Iterator[pa.RecordBatch]:
        words = list(counts)
        for lo in range(0, len(words), 20_000):
            some = words[lo:lo + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in some], pa.string()),
                                              pa.array([counts[w] for w in some], pa.int64())], names=["word", "n"])
        counts.clear()

    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            for word, n in spellings(doc_id, text, min_length):
                counts[word] = counts.get(word, 0) + n
            if len(counts) >= limit:
                yield from passed_on()
    yield from passed_on()


def word_counts(docs: DataFrame, key: Column, text: Column, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n``: words of at least ``min_length`` letters, ``min_count`` times
    or more in all texts."""
    rows = docs.select(null_to_empty(key.cast("string")).alias("key"), null_to_empty(text).alias("text"))
    blocks = rows.mapInArrow(functools.partial(_counted, min_length, BLOCK_WORDS), "word string, n bigint")
    return blocks.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- signatures ----------------------------------------------------------

@functools.lru_cache(maxsize=1 << 16)
def _part(letter: str, occurrence: int, parts: int) -> int:
    return zlib.crc32(f"{letter}{occurrence}".encode()) % parts


def _enumerated(elements: list[tuple[str, int]], parts: int, distance: int) -> list[str]:
    """The choices of all but ``distance`` parts of the vector, with their elements."""
    cut = [""] * parts
    for letter, occurrence in elements:
        cut[_part(letter, occurrence, parts)] += letter + chr(occurrence)
    return ["\0".join(map(str, left)) + "\1" + "\2".join(cut[i] for i in left)
            for left in itertools.combinations(range(parts), parts - distance)]


def signatures(word: str, same_parts: int = SAME_PARTS, cross_parts: int = CROSS_PARTS) -> list[str]:
    """Signatures of a word; words one edit apart share at least one."""
    seen: Counter = Counter()
    elements = []
    for letter in sorted(word):
        seen[letter] += 1
        elements.append((letter, seen[letter]))
    size, out = len(word), []
    half = size // 2
    for s in _enumerated(elements, same_parts, 2):
        out += [f"{size}={word[:half]}\3{s}", f"{size}=\3{word[half:]}\3{s}"]
    cross = _enumerated(elements, cross_parts, 1)
    for shorter in (size - 1, size):  # of the two words' lengths
        half = shorter // 2
        first, last = word[:half], word[size - (shorter - half):]
        for s in cross:
            out += [f"{shorter}+{first}\3{s}", f"{shorter}+\3{last}\3{s}"]
    return out


def without_one(word: str) -> list[str]:
    """Keys that only words share which differ by one letter: the place and the other
    letters (equal lengths); the shorter word (lengths that differ by one)."""
    cuts = [word[:i] + word[i + 1:] for i in range(len(word))]
    return [f"{i}={c}" for i, c in enumerate(cuts)] + [f"+{word}"] + [f"+{c}" for c in dict.fromkeys(cuts)]


def _keys(make, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``make(word)`` hashed to 64 bits; equal hashes only cost a check."""
    import xxhash

    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            some = batch.slice(lo, 1000)
            keys = [[xxhash.xxh64_intdigest(k.encode()) - (1 << 63) for k in make(w)] for w in some.column(0).to_pylist()]
            own = pa.array([i for i, k in enumerate(keys) for _ in k], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([x for k in keys for x in k], pa.int64()),
                                              *(c.take(own) for c in some.columns)], names=["key", "word", "n"])


def _keyed(words: DataFrame, make) -> DataFrame:
    return words.select("word", "n").mapInArrow(functools.partial(_keys, make), "key bigint, word string, n bigint")


def _met(keys: DataFrame) -> DataFrame:
    """Verified pairs (``a`` < ``b``) of words that share a key; some more than once."""
    left = keys.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = keys.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    near = (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & (F.levenshtein("a", "b", 1) == 1)
    return left.join(right, near).select("a", "a_n", "b", "b_n")


def near_pairs(words: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Pairs of ``words`` (``word``, ``n``; distinct) one edit apart, each once: ``a`` <
    ``b`` with ``a_n``, ``b_n``."""
    spark = words.sparkSession
    folder = scratch_path(spark, "spelling-keys")
    _keyed(words, signatures).write.mode("overwrite").parquet(folder)
    keys = spark.read.parquet(folder)
    hot = keys.groupBy("key").agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > group_limit).select("key").checkpoint()
    n_hot = hot.count()
    few = F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot
    found = _met(keys.join(few, "key", "left_anti"))
    if n_hot:
        crowded = keys.join(few, "key", "left_semi").select("word", "n").distinct()
        found = found.unionByName(_met(_keyed(crowded, without_one)))
    return found.distinct()


# --- forms ---------------------------------------------------------------

def variants(words: DataFrame, ratio: int = FORM_RATIO, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of ``words`` (``word``, ``n``).

    A word's form is its most frequent near word (of equally frequent ones the least
    in code-point order) if that has at least ``ratio`` times its count, else null.
    ``root`` is the last of the chain of forms.
    """
    checkpoint_dir(words.sparkSession)
    words = words.checkpoint()
    pairs = near_pairs(words, group_limit)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("other_n")).alias("minus_n"), "other")).alias("best"))
    most = -F.col("best.minus_n")
    formed = most >= F.col("n") * ratio
    rows = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(formed, F.col("best.other")).alias("form"), F.when(formed, most).alias("form_n")).checkpoint()
    roots = _roots(rows.where("form IS NOT NULL").select("word", "form"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """The end of each chain, by doubling the steps.  Counts grow along a chain by the
    ratio, so with 64-bit counts a few rounds reach the end."""
    state = forms.select("word", F.col("form").alias("root"))
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = state.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")).checkpoint()
        state = joined.select("word", "root")
        if joined.where("moved").limit(1).count() == 0:
            return state


def spelling_variants(docs: DataFrame, key: Column, text: Column) -> DataFrame:
    """Spelling variants of the words of all texts (see ``variants``).

    Null texts have no words, a null key counts as empty; texts and words of any
    length are taken whole and repeated rows count as often as they occur.  Other
    columns are not read, whatever their names; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    return variants(word_counts(docs, key, text))


def variants_sql() -> str:
    """DuckDB SQL for the registered query.  Words one edit apart are found by their
    spelling without one letter; the checksum runs over a table made by its rule."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH RECURSIVE crc(t) AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
g AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s, run, count(*) AS n FROM r WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
b AS (SELECT run, n, list_transform(range(octet_length(encode(s))), lambda i: CAST('0x' || hex(encode(s))[2 * i + 1:2 * i + 2] AS BIGINT)) AS bytes FROM g),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM b, crc),
w AS (SELECT CASE WHEN h % {DROP_ONE_IN} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM h),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
cut AS MATERIALIZED (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT DISTINCT * FROM (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT a.word, b.word, b.n FROM words a JOIN cut b ON a.word = b.rest
  UNION ALL SELECT b.word, a.word, a.n FROM words a JOIN cut b ON a.word = b.rest)),
best AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM near),
f AS MATERIALIZED (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {FORM_RATIO} * words.n THEN other END AS form,
  CASE WHEN other_n >= {FORM_RATIO} * words.n THEN other_n END AS form_n FROM words LEFT JOIN best ON best.word = words.word AND k = 1),
chain(word, last, next) AS (SELECT word, word, form FROM f
  UNION ALL SELECT chain.word, f.word, f.form FROM chain JOIN f ON f.word = chain.next)
SELECT f.word, f.form, chain.last AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM f JOIN chain ON chain.word = f.word AND chain.next IS NULL"""
