"""SimHash fingerprints and exact near-duplicate groups of them.

Linking is exact for any Hamming distance up to ``TAU`` = 2 and never lists the
pairs of a group:

1. Equal fingerprints are one row from here on, with their least document id.
2. Candidates by pigeonring.  The 64 bits are a ring of ``SEGMENTS`` segments.  If two
   fingerprints differ in at most ``TAU`` bits, some chain of consecutive
   segments keeps its cumulative differences within ``floor(l * TAU / SEGMENTS)``
   for every length ``l``.  As long as the budget is zero the segments must be
   equal, so each fingerprint gives one key for each start of a chain: the
   start and the bits of those leading segments (26 of 64).  Fingerprints that share
   a key meet: the cumulative differences are followed along the ring, a pair that
   exceeds a budget is dropped there, and the last budget is the full check.  A group
   returns a spanning forest of its links, never the links.
3. Keys that more than ``GROUP_LIMIT`` fingerprints share are left out of that step.
   Of their fingerprints, those stay that share the bits of the longest chain of
   budget one (51 or 52 of 64) with one of the later ones left out.  What is left
   meets through neighbours: two values differ in at most two bits exactly if some
   value is within one bit of both, so each gives itself and its 64 one-bit neighbours
   as keys, and everything that meets at a key is linked to the least fingerprint
   there.  A group of n gives 65 n rows that are pre-aggregated before the shuffle.
4. Connected components of these links.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import null_to_empty, per_text
from cartwheel.llm.components import connected_components
from cartwheel.session import checkpoint_dir, ship_package

BITS = 64
TAU = 2
SEGMENTS = 5
# Fingerprints that are compared with one another under one chain key.
GROUP_LIMIT = 2000
SEED = 42
WORDS = 3


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of a text's word shingles (signed, as Spark stores it).

    A-Z are lower-cased, words are runs of non-white-space (ASCII white space),
    shingles are joined by one space and repeats count.  Fewer words than a
    shingle: the whole sequence is the only shingle; no words: zero.
    """
    import xxhash

    tokens = text.encode("utf-8").lower().split()  # bytes: only A-Z and ASCII white space
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = list(map(b" ".join, zip(*(tokens[i:] for i in range(words)))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), "<u8", len(shingles))
    counts = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), 65_536):
        part = hashes[lo:lo + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(df: DataFrame, key: Column, text: Column, key_type: str = "bigint") -> DataFrame:
    """Rows ``(doc_id, fp bigint)``, one for each input row; a null text counts as empty."""
    ship_package(df.sparkSession)
    return per_text(df, [key.alias("doc_id"), null_to_empty(text).alias("text")],
                    lambda doc_id, body: (doc_id, fingerprint(body)), f"doc_id {key_type}, fp bigint")


def segment_bounds(segments: int = SEGMENTS) -> list[tuple[int, int]]:
    """Start and width of each segment of the ring."""
    small, extra = divmod(BITS, segments)
    widths = [small + (i < extra) for i in range(segments)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def chain_lengths(segments: int = SEGMENTS, tau: int = TAU) -> tuple[int, int]:
    """Longest chains whose budget ``floor(length * tau / segments)`` is 0 and at most 1."""
    return tuple(max(n for n in range(segments + 1) if n * tau // segments <= budget) for budget in (0, 1))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _chain_bits(start: int, first: int, last: int, segments: int) -> list[int]:
    """Bit numbers of the segments ``first`` to ``last - 1`` of the chain from ``start``."""
    bounds = segment_bounds(segments)
    return [bit for step in range(first, last) for at, width in [bounds[(start + step) % segments]]
            for bit in range(at, at + width)]


def chain_keys(fp: Column, segments: int = SEGMENTS, tau: int = TAU) -> Column:
    """One key for each chain start: its number and the bits of the segments
    that the chain's zero budgets force to be equal."""
    equal, _ = chain_lengths(segments, tau)
    masks = [sum(1 << b for b in _chain_bits(start, 0, equal, segments)) for start in range(segments)]
    return F.array(*(F.struct(F.lit(start).alias("start"), fp.bitwiseAND(F.lit(_signed(m))).alias("bits"))
                     for start, m in enumerate(masks)))


def masked_keys(fp: Column, start: Column, segments: int = SEGMENTS, tau: int = TAU) -> Column:
    """Keys for the chain's budgets of one: the bits of the longest such chain with
    one bit of its later segments left out.  Two values whose leading segments are
    equal share one of them exactly if they differ in at most one bit there."""
    equal, one = chain_lengths(segments, tau)
    out = []
    for s in range(segments):
        whole = sum(1 << b for b in _chain_bits(s, 0, one, segments))
        out.append(F.array(*(F.struct(F.lit(b).alias("left_out"), F.lit(_signed(whole & ~(1 << b))).cast("bigint").alias("mask"))
                             for b in _chain_bits(s, equal, one, segments))))
    return F.transform(F.get(F.array(*out), start), lambda m: F.struct(
        m["left_out"].alias("left_out"), fp.bitwiseAND(m["mask"]).alias("bits")))


def _sharing(keyed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``keyed`` whose key another ``fp`` has too (counted by a pre-aggregate)."""
    shared = (keyed.groupBy(*keys).agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
              .where("lo <> hi").select(*keys))
    return keyed.join(shared, keys, "left_semi")


def with_partners(values: DataFrame, segments: int = SEGMENTS, tau: int = TAU) -> DataFrame:
    """The distinct ``fp`` of ``values`` that keep within the budgets of 0 and 1 of
    some chain with another one (every ``fp`` that has a partner does)."""
    keyed = values.select("fp", F.explode(chain_keys(F.col("fp"), segments, tau)).alias("key")).select(
        "fp", "key.start", "key.bits")
    equal = _sharing(keyed, ["start", "bits"]).select("fp", "start")
    masked = equal.select("fp", "start", F.explode(masked_keys(F.col("fp"), F.col("start"), segments, tau)).alias("key"))
    masked = masked.select("fp", "start", "key.left_out", "key.bits")
    return _sharing(masked, ["start", "left_out", "bits"]).select("fp").distinct()


def hamming_links(values: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect every two ``fp`` of ``values`` within two bits.

    ``b`` is the least value within one bit of a common neighbour, so every link
    joins two values that differ in at most two bits.
    """
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")
                                            for i in range(BITS)))
    near = values.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("hub"))
    hubs = (near.groupBy("hub").agg(F.min("fp").alias("b"), F.max("fp").alias("top"))
            .where("b <> top").select("hub", "b"))
    return near.join(hubs, "hub").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def _forest(segments: int, tau: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (start, bits, fp) to links that span each group's near pairs."""
    masks = [[sum(1 << b for b in _chain_bits(start, 0, length, segments)) for length in range(1, segments + 1)]
             for start in range(segments)]

    def links(start: int, fps: np.ndarray) -> tuple[list[int], list[int]]:
        """A spanning forest: a breadth-first walk that compares a value only with those
        not yet reached."""
        values, left, a, b = fps.view(np.uint64), np.arange(1, len(fps)), [], []
        queue = [0]
        while len(left):
            if not queue:
                queue, left = [left[0]], left[1:]
                continue
            i = queue.pop()
            near, differ = np.arange(len(left)), values[left] ^ values[i]
            for length, mask in enumerate(masks[start], 1):
                near = near[np.bitwise_count(differ[near] & np.uint64(mask)) <= length * tau // segments]
            found = left[near]
            a += [int(fps[i])] * len(found)
            b += fps[found].tolist()
            queue += found.tolist()
            left = np.delete(left, near)
        return a, b

    def done(columns: list[np.ndarray]) -> pa.RecordBatch:
        start, bits, fp = columns
        cuts = np.flatnonzero(np.append(True, (start[1:] != start[:-1]) | (bits[1:] != bits[:-1])))
        a, b = [], []
        for lo, hi in zip(cuts, np.append(cuts[1:], len(fp))):
            if hi - lo > 1:
                x, y = links(int(start[lo]), fp[lo:hi])
                a += x
                b += y
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        if held is not None:
            columns = [np.concatenate(pair) for pair in zip(held, columns)]
        # The last group of a batch waits for the next one.
        last = np.flatnonzero((columns[0] != columns[0][-1]) | (columns[1] != columns[1][-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        held = [c[cut:] for c in columns]
        if cut:
            yield done([c[:cut] for c in columns])
    if held is not None:
        yield done(held)


def near_links(values: DataFrame, segments: int = SEGMENTS, tau: int = TAU, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Links ``(a, b)`` that connect every two of the distinct ``fp`` of ``values`` within
    ``tau`` bits (2 where a key is shared by more than ``group_limit``); every link
    joins two such values."""
    keyed = values.select("fp", F.explode(chain_keys(F.col("fp"), segments, tau)).alias("key")).select(
        "fp", "key.start", "key.bits")
    sizes = keyed.groupBy("start", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1").checkpoint()
    met = keyed.join(sizes.where(F.col("n") <= group_limit), ["start", "bits"], "left_semi")
    ordered = met.select("start", "bits", "fp").repartition("start", "bits").sortWithinPartitions("start", "bits", "fp")
    links = ordered.mapInArrow(functools.partial(_forest, segments, tau), "a bigint, b bigint")
    crowded = sizes.where(F.col("n") > group_limit)
    if crowded.limit(1).count():
        members = keyed.join(crowded, ["start", "bits"], "left_semi").select("fp").distinct()
        links = links.unionByName(hamming_links(with_partners(members, segments, tau)))
    return links


def near_duplicates(df: DataFrame, key: Column, text: Column, key_type: str = "bigint") -> DataFrame:
    """Rows ``(doc_id, fingerprint, component_id)``, one for each input row.

    Fingerprints that differ in two bits or fewer are linked; ``component_id``
    is the least document id reachable.  Empty and null texts share fingerprint
    zero and are linked like any other.  Rows with a null id take part: their
    component is the least non-null id of the group (null if there is none).
    Repeated rows give repeated rows.  An empty table gives an empty result.
    """
    checkpoint_dir(df.sparkSession)
    rows = fingerprints(df, key, text, key_type).checkpoint()
    values = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    parts = connected_components(near_links(values.select("fp")))
    rooted = values.join(parts, values["fp"] == parts["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    member = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(member, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row of ``df`` for each near-duplicate group, all columns unchanged.

    The row with the least key stays (a null key only if the group has no other;
    among rows that share it the one whose columns hash least).
    """
    spark = df.sparkSession
    ship_package(spark)
    checkpoint_dir(spark)
    # One struct holds the input's columns, so none can clash.
    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))
    columns = [F.col(f"row.`{key}`").alias("id"), F.xxhash64("row").alias("hash"), null_to_empty(F.col(f"row.`{text}`")).alias("text")]
    narrow = per_text(packed, columns, lambda row_id, hashed, body: (row_id, hashed, fingerprint(body)),
                      f"id {df.schema[key].dataType.simpleString()}, hash bigint, fp bigint").checkpoint()
    order = F.struct(F.col("id").isNull().alias("n"), "id", "fp", "hash")
    values = narrow.groupBy("fp").agg(F.min(order).alias("first"))
    parts = connected_components(near_links(values.select("fp")))
    rooted = values.join(parts, values["fp"] == parts["node"], "left").select(
        "first", F.coalesce("root", "fp").alias("root"))

    # One key for the join and the window, so that rows are shuffled once.
    def place(row_id: Column, hashed: Column) -> Column:
        return F.concat_ws(":", F.coalesce(row_id.cast("string"), F.lit("null")), hashed.cast("string")).alias("place")

    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(place(F.col("first.id"), F.col("first.hash")))
    met = packed.select("row", place(F.col(f"row.`{key}`"), F.xxhash64("row"))).join(kept, "place", "left_semi")
    # Equal rows share a place.
    one = Window.partitionBy("place").orderBy(F.lit(0))
    return met.withColumn("n", F.row_number().over(one)).where("n = 1").select("row.*")
