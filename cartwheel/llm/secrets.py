"""Secret scan in DataFrame functions only.

Three patterns give the base spans: assignments of a password or key, cloud
access keys and long hexadecimal runs.  The entropy method adds candidate
strings: runs of key-like characters that mix letters and digits.  A window of
``WINDOW`` characters slides over a candidate; the counts of its characters and
the sum of ``c * log2(c)`` over them are updated with the character that enters
and the one that leaves.  A candidate is reported if its least predictable
window reaches the Shannon entropy asked of its character class (hexadecimal,
letters and digits, base 64) and no allow-list pattern covers it.

Everything is computed within a row: no shuffle, no Python on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import null_to_empty

KINDS = ("assign", "access", "hex", "entropy")


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = ("(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
          + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_VALUE = 12
# For runs of one class, asking for the length in the pattern finds the same
# matches as dropping the short ones afterwards.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# Bits per character that a window must reach, by the candidate's class.
THRESHOLDS = (("^[0-9a-fA-F]+$", 3.0), ("^[A-Za-z0-9]+$", 3.65), ("", 3.85))
# Candidates that are not secrets: parts that are each a plain word or number
# (paths, slugs, names), placeholders, and runs of the alphabet.
ALLOW = (
    r"^[+/_=-]*([A-Z]?[a-z]+|[A-Z]+|[0-9]+)([+/_=-]+([A-Z]?[a-z]+|[A-Z]+|[0-9]+))*[+/_=-]*$",
    r"[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Xx]{6}|[*]{4}",
    r"0123456789|abcdefghij|ABCDEFGHIJ",
)
# The first of them as the executors test it, part by part: Java's matcher recurses
# for each repetition of a group, so a candidate of many parts would end its JVM.
SEPARATOR = "[+/_=-]+"
PLAIN_PART = "^([A-Z]?[a-z]+|[A-Z]+|[0-9]+)$"
# c * log2(c) in fixed point, so that sums do not depend on their order.
_UNIT = 1 << 24
_PLOGP = [round(c * math.log2(c) * _UNIT) if c else 0 for c in range(WINDOW + 2)]


def _limit(bits: float) -> int:
    """Largest sum of c * log2(c) in a window whose entropy reaches ``bits``."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * _UNIT)


SPAN = "struct<start:int,kind:int,end:int>"
# Code points of a block of text, within which places are counted.
TEXT_BLOCK = 4096


def _running(items: Column, kind: str, first: Column, value, join, emit) -> Column:
    """``emit(total before the item, item)``, an array, for each item in order, flattened.

    ``join`` adds up ``value(item)``, an int, from ``first``.  Appending to one array
    copies it each time, so items are taken in blocks of about the root of their
    number: the blocks' totals are added up first, then each block is read with its own
    array.  That is n ** 1.5 copied references in all.
    """
    empty = F.array().cast(f"array<{kind}>")
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(items))).cast("int"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / width).cast("int")),
                         lambda c: F.slice(items, c * width + 1, width))
    totals = F.transform(blocks, lambda b: F.aggregate(b, first, lambda t, x: join(t, value(x))))
    before = F.aggregate(totals, F.struct(first.alias("at"), F.array().cast("array<int>").alias("out")), lambda acc, t: F.struct(
        join(acc["at"], t).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
    inner = F.zip_with(before, blocks, lambda t, b: F.aggregate(
        b, F.struct(t.alias("at"), empty.alias("out")), lambda acc, x: F.struct(
            join(acc["at"], value(x)).alias("at"), F.concat(acc["out"], emit(acc["at"], x)).alias("out")),
        lambda acc: acc["out"]))
    return F.when(F.size(items) == 0, empty).otherwise(F.flatten(inner))


def _parts(text: Column, pattern: str, keep) -> Column:
    """The gaps and matches of ``pattern`` in turn: their sizes, and whether ``keep``
    accepts the match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(F.split(text, pattern, -1), found, lambda gap, hit: F.struct(
        F.length(gap).alias("gap"), F.coalesce(F.length(hit), F.lit(0)).alias("size"),
        F.coalesce(keep(hit), F.lit(False)).alias("ok")))
    return F.when(text.rlike(pattern), parts).otherwise(F.array().cast("array<struct<gap:int,size:int,ok:boolean>>"))


def _spans(parts: Column, kind: int) -> Column:
    """Accepted matches as (start, kind, end) in code points: a match starts where the
    gaps and matches before it end."""
    def span(at: Column, p: Column) -> Column:
        own = F.struct((at + p["gap"]).alias("start"), F.lit(kind).alias("kind"), (at + p["gap"] + p["size"]).alias("end"))
        return F.when(p["ok"], F.array(own)).otherwise(F.array().cast(f"array<{SPAN}>"))

    return _running(parts, SPAN, F.lit(0), lambda p: p["gap"] + p["size"], lambda t, v: t + v, span)


def _uncovered(spans: Column) -> Column:
    """Of spans sorted by (start, kind): the base ones, and the entropy ones that no base
    span contains, that is, that end behind every base span that starts no later."""
    last = KINDS.index("entropy")
    return _running(spans, SPAN, F.lit(-1), lambda s: F.when(s["kind"] == last, F.lit(-1)).otherwise(s["end"]),
                    F.greatest, lambda reach, s: F.when(
                        (s["kind"] == last) & (reach >= s["end"]), F.array().cast(f"array<{SPAN}>")).otherwise(F.array(s)))


def least_predictable(candidate: Column) -> Column:
    """Least sum of c * log2(c) over the windows of a candidate (in fixed point)."""
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    plogp = F.array(*(F.lit(v).cast("bigint") for v in _PLOGP))
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"), F.lit(0).cast("bigint").alias("sum"),
        F.lit(0).alias("n"), F.lit(1 << 60).cast("bigint").alias("best"))

    def moved(counts: Column, code: Column, by: int) -> Column:
        return F.transform(counts, lambda c, i: F.when(i == code, c + by).otherwise(c))

    def step(acc: Column, pair: Column) -> Column:
        entering, leaving = pair["entering"], pair["leaving"]
        left = F.when(leaving > 0, moved(acc["counts"], leaving, -1)).otherwise(acc["counts"])
        gone = F.get(acc["counts"], leaving)
        total = acc["sum"] + F.when(leaving > 0, F.get(plogp, gone - 1) - F.get(plogp, gone)).otherwise(F.lit(0))
        had = F.get(acc["counts"], entering) - F.when(leaving == entering, F.lit(1)).otherwise(F.lit(0))
        total = total + F.get(plogp, had + 1) - F.get(plogp, had)
        return F.struct(
            moved(left, entering, 1).alias("counts"), total.alias("sum"), (acc["n"] + 1).alias("n"),
            F.when(acc["n"] + 1 >= WINDOW, F.least(acc["best"], total)).otherwise(acc["best"]).alias("best"))

    # Each step sees the code that enters and the one WINDOW places before it.
    pairs = F.zip_with(codes, F.concat(F.array_repeat(F.lit(0), WINDOW), codes), lambda a, b: F.struct(
        a.alias("entering"), b.alias("leaving")))
    return F.aggregate(F.filter(pairs, lambda p: p["entering"].isNotNull()), start, step, lambda acc: acc["best"])


def _surprising(candidate: Column) -> Column:
    limit = F.lit(_limit(THRESHOLDS[-1][1]))
    for pattern, bits in reversed(THRESHOLDS[:-1]):
        limit = F.when(candidate.rlike(pattern), F.lit(_limit(bits))).otherwise(limit)
    parts = F.filter(F.split(candidate, SEPARATOR, -1), lambda part: part != "")
    allowed = (F.size(parts) > 0) & F.forall(parts, lambda part: part.rlike(PLAIN_PART))
    for pattern in ALLOW[1:]:
        allowed = allowed | candidate.rlike(pattern)
    mixed = candidate.rlike("[0-9]") & candidate.rlike("[A-Za-z]")
    return F.when(mixed & ~allowed, least_predictable(candidate) <= limit).otherwise(F.lit(False))


def scan(df: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """Columns ``keep`` and ``base``, ``spans``: arrays of (start, kind, end).

    Positions count code points, ``end`` is exclusive and ``kind`` indexes
    ``KINDS``.  ``base`` holds the pattern matches, leftmost and not overlapping
    within a kind, ordered by start and kind; ``spans`` also the entropy spans
    that no base span contains.  A null text counts as empty and has no spans; texts
    of any length are read whole; repeated rows, null keys and other columns pass
    through unchanged; an empty table gives no rows.
    """
    rows = df.select(*keep, null_to_empty(text).alias("_text"))
    value = F.col("_text")
    kept = [F.col(f"`{c}`") for c in rows.columns[:-1]]
    rows = rows.select(
        "*",
        _parts(value, ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_VALUE).alias("_assign"),
        _parts(value, ACCESS, lambda m: m.isNotNull()).alias("_access"),
        _parts(value, HEX, lambda m: m.isNotNull()).alias("_hex"),
        _parts(value, CANDIDATE, _surprising).alias("_entropy"))
    rows = rows.select(*kept, *(_spans(F.col(c), k).alias(c) for k, c in enumerate(("_assign", "_access", "_hex", "_entropy"))))
    rows = rows.select(*kept, F.array_sort(F.concat("_assign", "_access", "_hex")).alias("base"), "_entropy")
    rows = rows.select(*kept, "base", F.array_sort(F.concat("base", "_entropy")).alias("_all"))
    return rows.select(*kept, "base", _uncovered(F.col("_all")).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _piece(blocks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text cut into blocks: a place is searched
    within its block only."""
    first, last = F.floor(start / TEXT_BLOCK).cast("int"), F.floor((end - 1) / TEXT_BLOCK).cast("int")
    head, tail = F.get(blocks, first), F.get(blocks, last)
    across = F.concat(F.substring(head, start % TEXT_BLOCK + 1, F.lit(TEXT_BLOCK)),
                      F.array_join(F.slice(blocks, first + 2, last - first - 1), ""),
                      F.substring(tail, F.lit(1), (end - 1) % TEXT_BLOCK + 1))
    within = F.substring(head, start % TEXT_BLOCK + 1, end - start)
    return F.when(start >= end, F.lit("")).when(first == last, within).otherwise(across)


def redacted(text: Column, spans: Column, mark: str = "[REDACTED]") -> Column:
    """The text with every maximal run of overlapping spans (sorted by start) replaced
    by ``mark``."""
    gap = "struct<start:int,end:int>"

    def gaps(reach: Column, s: Column) -> Column:
        """The text between runs, where a span starts a run."""
        return F.when(s["start"] >= reach, F.array(F.struct(reach.alias("start"), s["start"].alias("end")))).otherwise(
            F.array().cast(f"array<{gap}>"))

    def joined_up(v: Column) -> Column:
        cuts = _running(v["spans"], gap, F.lit(0), lambda s: s["end"], F.greatest, gaps)
        kept = F.transform(cuts, lambda g: F.concat(_piece(v["blocks"], g["start"], g["end"]), F.lit(mark)))
        end = F.array_max(F.transform(v["spans"], lambda s: s["end"]))
        return F.concat(F.array_join(kept, ""), _piece(v["blocks"], end, v["size"]))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))
    whole = F.struct(blocks.alias("blocks"), spans.alias("spans"), F.length(text).alias("size"))
    return F.when(F.size(spans) == 0, text).otherwise(_bound(whole, joined_up))


def scan_sql() -> str:
    """DuckDB SQL for the registered query: windows are counted anew, not incrementally."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def spans(name: str, pattern: str, kind: int, keep: str) -> str:
        # A match starts where the gaps and matches before it end.
        return f"""{name}_m AS (SELECT doc_id, string_split_regex(text, {quoted(pattern)}) AS gaps, regexp_extract_all(text, {quoted(pattern)}) AS hits
  FROM d WHERE regexp_matches(text, {quoted(pattern)})),
{name}_i AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM {name}_m),
{name} AS (SELECT doc_id, s, {kind} AS kind, s + length(hit) AS e FROM (
  SELECT doc_id, hits[i] AS hit, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s FROM {name}_i) WHERE {keep})"""

    limit = str(_limit(THRESHOLDS[-1][1]))
    for pattern, bits in reversed(THRESHOLDS[:-1]):
        limit = f"CASE WHEN regexp_matches(hit, {quoted(pattern)}) THEN {_limit(bits)} ELSE {limit} END"
    allowed = " OR ".join(f"regexp_matches(hit, {quoted(p)})" for p in ALLOW)
    plogp = "[" + ", ".join(map(str, _PLOGP)) + "]"
    chars = f"string_split(substring(hit, p, {WINDOW}), '')"
    score = (f"list_sum(list_transform(list_distinct({chars}), lambda c: {plogp}"
             f"[len(list_filter({chars}, lambda x: x = c)) + 1]))")
    surprising = (f"CASE WHEN regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]') AND NOT ({allowed}) THEN "
                  f"list_min(list_transform(range(1, length(hit) - {WINDOW - 2}), lambda p: {score})) <= {limit} ELSE FALSE END")
    names = "[" + ", ".join(map(quoted, KINDS)) + "]"
    text = f"string_agg({names}[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind)"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{spans("assign", ASSIGN, 0, f"length(regexp_extract(hit, {quoted(ASSIGN)}, 2)) >= {ASSIGN_VALUE}")},
{spans("access", ACCESS, 1, "TRUE")},
{spans("hex", HEX, 2, "TRUE")},
{spans("candidate", CANDIDATE, 3, surprising)},
base AS (SELECT * FROM assign UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hex),
every AS (SELECT * FROM base UNION ALL SELECT * FROM candidate c WHERE NOT EXISTS (
  SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.s <= c.s AND b.e >= c.e)),
b AS (SELECT doc_id, COUNT(*) FILTER (WHERE kind = 0) AS n_assign, COUNT(*) FILTER (WHERE kind = 1) AS n_access,
  COUNT(*) FILTER (WHERE kind = 2) AS n_hex, {text} AS names FROM base GROUP BY doc_id),
a AS (SELECT doc_id, {text} AS names FROM every GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.names, '')) AS base_sha256, coalesce(a.names, '') AS spans
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id)"""
