"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every word shingle is hashed once.  The top bits of the hash choose one of
``BINS`` bins and each bin keeps its least hash.  An empty bin copies the filled bin
that comes first in an order of the bins of its own, the same for all documents
(optimal densification): universal hashing of (bin, attempt) names the first
``ASKED`` places, the least hash of (bin, filled bin) decides among all that are
left, so the search always ends at a filled bin.  Of each bin's value the low ``BITS`` bits are stored,
packed into 64-bit words.  The share of equal bins, corrected for chance
agreement of the low bits, estimates the Jaccard likeness of the shingle sets.

Sorting the hashes together with one marker for each bin puts a bin's least
hash right behind its marker, so binning needs no per-bin pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import null_to_empty, shuffle_partitions
from cartwheel.session import checkpoint_dir

BINS = 256
BITS = 8
WORDS = 5
# Bins that an empty bin asks by number before it ranks all filled ones.
ASKED = 12
_BIN_SHIFT = 63 - (BINS.bit_length() - 1)
_PER_WORD = 64 // BITS
_SPACES = " \t\n\x0b\x0c\r"


def _mix(x: int) -> int:
    """A 64-bit finaliser (public-domain constants), for the densification's choices."""
    x = (x + 0x9E3779B97F4A7C15) & (2**64 - 1)
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
    return x ^ (x >> 31)


def probe(bin_: int, attempt: int) -> int:
    """The bin that an empty bin asks at an attempt."""
    return _mix(bin_ * 1_000_003 + attempt) % BINS


def _longs(values) -> Column:
    return F.array(*(F.lit(v).cast("bigint") for v in values))


def with_fingerprint(df: DataFrame, text: str, out: str, words: int = WORDS) -> DataFrame:
    """Add ``out``: the packed fingerprint (``BINS * BITS / 64`` longs) of column ``text``.

    Words are runs of anything but ASCII white space, unchanged.  A text with
    fewer words than a shingle is one shingle; a null text or one without words
    has an empty array.  Equal texts have equal fingerprints.
    """
    names = [c for c in df.columns if c != out]
    kept = [F.col(f"`{c}`") for c in names]
    step = df.select(*kept, F.split(F.btrim(null_to_empty(F.col(text)), F.lit(_SPACES)),
                                    r"[\x20\x09-\x0D]+", -1).alias("_w"))
    w, n = F.col("_w"), F.size("_w")
    shingles = (F.when(F.get(w, F.lit(0)) == "", F.array().cast("array<bigint>"))
                .when(n < words, F.array(F.xxhash64(F.concat_ws(" ", w))))
                .otherwise(F.transform(F.sequence(F.lit(0), n - words), lambda i: F.xxhash64(
                    *(F.get(w, i + k) for k in range(words))))))
    step = step.select(*kept, shingles.alias("_h"))
    # 63 bits with the lowest one set; markers have it clear.
    placed = F.transform("_h", lambda h: F.shiftrightunsigned(h, 1).bitwiseOR(F.lit(1).cast("bigint")))
    step = step.select(*kept, F.sort_array(F.concat(
        placed, _longs(b << _BIN_SHIFT for b in range(BINS)))).alias("_s"))
    s, one = F.col("_s"), F.lit(1).cast("bigint")
    marks = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: F.get(s, j).bitwiseAND(one) == 0)
    step = step.select(*kept, F.when(F.size(s) > BINS, F.transform(marks, lambda j: F.when(
        F.get(s, j + 1).bitwiseAND(one) == 1, F.get(s, j + 1)))).alias("_b"))
    b = F.col("_b")
    filled = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.get(b, i).isNotNull())
    step = step.select(*kept, "_b", F.when(b.isNotNull(), filled).alias("_in"))
    asked = [F.array(*(F.lit(probe(i, a)) for i in range(BINS))) for a in range(ASKED)]
    ranked = lambda i: F.get(b, F.array_min(F.transform(
        "_in", lambda j: F.struct(F.xxhash64(i, j).alias("h"), j.alias("j"))))["j"])
    full = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.coalesce(
        F.get(b, i), *(F.get(b, F.get(p, i)) for p in asked), ranked(i)))
    step = step.select(*kept, F.when(b.isNotNull(), full).alias("_f"))
    f = F.col("_f")

    def packed(j: Column) -> Column:
        out_ = F.lit(0).cast("bigint")
        for k in range(_PER_WORD):
            low = F.shiftright(F.get(f, j * _PER_WORD + k), 1).bitwiseAND(F.lit((1 << BITS) - 1).cast("bigint"))
            out_ = out_.bitwiseOR(F.shiftleft(low, BITS * k))
        return out_

    return step.select(*kept, F.when(f.isNotNull(), F.transform(
        F.sequence(F.lit(0), F.lit(BINS // _PER_WORD - 1)), packed)).otherwise(
            F.array().cast("array<bigint>")).alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness (0 to 1) of two packed fingerprints.

    Two empty fingerprints are alike (1), an empty and another one are not (0).
    """
    def same(x: Column, y: Column) -> Column:
        total = F.lit(0)
        for k in range(_PER_WORD):
            low = F.shiftrightunsigned(x.bitwiseXOR(y), BITS * k).bitwiseAND(F.lit((1 << BITS) - 1).cast("bigint"))
            total = total + F.when(low == 0, F.lit(1)).otherwise(F.lit(0))
        return total

    equal = F.aggregate(F.zip_with(a, b, same), F.lit(0), lambda acc, x: acc + x)
    chance = 2.0 ** -BITS
    estimate = F.greatest(F.lit(0.0), (equal / F.lit(float(BINS)) - F.lit(chance)) / F.lit(1.0 - chance))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
            .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(estimate))


def as_text(fingerprint: Column) -> Column:
    """Lower-case hexadecimal of a packed fingerprint."""
    return F.array_join(F.transform(fingerprint, lambda v: F.lower(F.lpad(F.hex(v), 16, "0"))), "")


def range_buckets(df: DataFrame, key: str, rows_per_bucket: int = 20_000, most: int = 65_536) -> Column:
    """A column that numbers ranges of ``key`` of about equal size, in ascending order.

    The borders are approximate percentiles: their number is bounded by ``most``
    and their exact place has no effect on results.  Null keys come last.
    """
    rows = df.agg(F.count(key)).first()[0]
    parts = min(most, max(2 * shuffle_partitions(df.sparkSession), -(-rows // rows_per_bucket)))
    found = df.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)], max(10_000, 4 * parts))).first()[0]
    borders = sorted(set(found or []))
    if not borders:
        return F.when(F.col(key).isNull(), F.lit(1)).otherwise(F.lit(0))
    groups = [borders[i:i + 256] for i in range(0, len(borders), 256)]
    reached = lambda values: F.size(F.filter(values, lambda x: x <= F.col(key)))
    high = reached(_longs(g[0] for g in groups))
    inner = F.get(F.array(*(_longs(g) for g in groups)), high - 1)
    return (F.when(F.col(key).isNull(), F.lit(len(borders) + 1)).when(high == 0, F.lit(0))
            .otherwise((high - 1) * 256 + reached(inner)))


def _ranges(rows: DataFrame, key: str, rows_per_bucket: int) -> DataFrame:
    """``rows`` with ``_tie`` and ``_bucket``: ranges of (key, tie) in ascending order.

    A key (or null) with more rows than a range holds is a range of its own, cut
    into ranges of its tie.  A tie that still has more, that is, equal rows, is a range
    of its own again, and its rows are dealt into parts in any order.
    """
    checkpoint_dir(rows.sparkSession)
    tie = F.xxhash64(*(c for c in rows.columns if c != key))
    # Numbered before any shuffle, so that every evaluation deals a row alike.
    placed = rows.select("*", range_buckets(rows, key, rows_per_bucket).alias("_range"), tie.alias("_tie"),
                         F.monotonically_increasing_id().alias("_id"))
    whole = F.lit(0).cast("bigint")

    def crowded(df: DataFrame, within: list[str], by: str, n: str) -> DataFrame:
        """The values of ``by`` in ``within`` that have too many rows, with their parts."""
        counts = df.groupBy(*within, by).agg(F.ceil(F.count(F.lit(1)) / rows_per_bucket).alias(n))
        return counts.where(F.col(n) > 1).checkpoint()

    def met(df: DataFrame, found: DataFrame, within: list[str], by: str, place: str) -> DataFrame:
        """``df`` with the parts of a crowded value, and ``place``: a number that rises
        with ``by`` and is a crowded value's own."""
        names = {c: f"_at_{c}" for c in [*within, by]}
        values = found.select(*(F.col(c).alias(x) for c, x in names.items()), found.columns[-1])
        lists = values.groupBy(*(names[c] for c in within)).agg(F.sort_array(F.collect_list(names[by])).alias("_values"))
        same = lambda cs: [F.col(c).eqNullSafe(F.col(names[c])) for c in cs]
        out = df.join(values, same([*within, by]), "left").drop(*names.values()).join(lists, same(within), "left").drop(*names.values())
        below = F.size(F.filter("_values", lambda v: v < F.col(by))) + F.size(F.filter("_values", lambda v: v <= F.col(by)))
        return out.withColumn(place, F.coalesce(F.when(F.col("_values").isNotNull(), below), F.lit(0))).drop("_values")

    hot = crowded(placed, ["_range"], key, "_cuts")
    if hot.limit(1).count() == 0:
        return placed.select("*", F.struct("_range", F.lit(0).alias("_key"), whole.alias("_cut"), F.lit(0).alias("_own"),
                                           whole.alias("_part")).alias("_bucket")).drop("_range", "_id")
    cut = met(placed, hot, ["_range"], key, "_key")
    # The tie is a hash: its high half cuts it evenly.
    high = F.shiftrightunsigned(F.col("_tie").bitwiseXOR(F.lit(-(1 << 63)).cast("bigint")), 32)
    cut = cut.withColumn("_cut", F.coalesce(F.shiftrightunsigned(high * F.col("_cuts"), 32), whole))
    equal = crowded(cut.where("_cuts IS NOT NULL"), ["_range", "_key", "_cut"], "_tie", "_parts")
    cut = met(cut, equal, ["_range", "_key", "_cut"], "_tie", "_own")
    part = F.coalesce(F.pmod(F.xxhash64("_id"), F.col("_parts")), whole)
    return cut.select(*rows.columns, "_tie", F.struct("_range", "_key", "_cut", "_own", part.alias("_part")).alias("_bucket"))


def with_next(rows: DataFrame, key: str, columns: list[str], derive, rows_per_bucket: int = 20_000) -> DataFrame:
    """``derive(rows)`` with ``next_<column>`` of the row that follows by ``key``
    (after the last: the first), for ``columns`` of ``derive``'s result.

    Rows are dealt out by ranges of (key, tie) and read in order within a range; the
    last row of a range takes its values from the first row of the next range.  Those
    first rows, one for each range, are found among ``rows`` and derived on their
    own.  Rows that share a key follow each other by a hash of the other columns
    of ``rows``, null keys come last; neither is ever one task's work as a whole.
    """
    placed = _ranges(rows, key, rows_per_bucket)
    ordered = Window.partitionBy("_bucket").orderBy(F.col(key).asc_nulls_last(), "_tie")
    led = derive(placed).select("*", *(F.lead(c).over(ordered).alias(f"next_{c}") for c in columns),
                                F.lead(F.lit(True)).over(ordered).alias("_followed"))
    first = placed.select("*", F.row_number().over(ordered).alias("_n")).where("_n = 1")
    border = derive(first).select(F.col("_bucket").alias("_at"), *(F.col(c).alias(f"_first_{c}") for c in columns))
    # One narrow row for each range.
    every = Window.orderBy("_at")
    after = placed.select(F.col("_bucket").alias("_at")).distinct().select(
        F.col("_at").alias("_bucket"),
        F.coalesce(F.lead("_at").over(every), F.min("_at").over(Window.partitionBy(F.lit(0)))).alias("_at"))
    border = after.join(border, "_at").drop("_at")
    kept = [c for c in led.columns if not c.startswith(("next_", "_"))]
    return led.join(border, "_bucket").select(*kept, *(
        F.when(F.col("_followed"), F.col(f"next_{c}")).otherwise(F.col(f"_first_{c}")).alias(f"next_{c}")
        for c in columns))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of an edited text and their likenesses.

    The edited text has its last floor(n/2) code points replaced by the first as
    many (or all) of the next document by ascending ``doc_id``; the last document
    is followed by the first, a single one by itself.  A null text counts as
    empty.  Rows that share an id follow each other in an order that depends on
    their texts only; null ids come last.  Texts of any length are read whole.  Other
    columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select("doc_id", null_to_empty(F.col("text")).alias("text"))
    rows = with_next(rows, "doc_id", ["text", "sig"], lambda df: with_fingerprint(df, "text", "sig"))
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "sig", "next_sig",
        F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half),
                 F.substring(F.col("next_text"), F.lit(1), half)).alias("edited"))
    return with_fingerprint(rows, "edited", "edited_sig")
