"""Packing of tokenised documents into sequences of a fixed capacity, by minimum
bin slack.

1. Tokens.  Each document becomes token ids and an end id.  Its whole windows of
   ``capacity`` tokens fill sequences of their own; what remains (less than a
   window) is to be packed.  Tokens are staged as Parquet in the shared folder,
   with a place (task, row) for each document and its number among the task's
   remainders of the same length.
2. Plan.  Only the number of remainders of each length is gathered: at most
   ``capacity - 1`` counts, whatever the input's size.  A sequence takes the
   longest length left and the multiset of other lengths that comes closest to
   the capacity: a subset-sum over the counts, held as the bits of one integer,
   with the counts read back from the kept states.  The multiset is used as often
   as the counts allow, so the plan has a few steps for each length.  Where no
   multiset fits exactly, one more remainder is cut to fill the rest, and what is
   left of it returns to the counts: only the last sequence can have padding.
3. Places.  A remainder's number among all of its length (a running sum over the
   tasks' counts) names its step, its repetition and its offset.

The tokens are shuffled once, to meet their places.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import null_to_empty
from cartwheel.session import scratch_path, ship_package

CAPACITY = 2048
END_ID = 1
_RANK_BITS = 44


# --- tokens --------------------------------------------------------------

# The split pattern of byte-level tokenizers of this kind.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others,
    in order, as the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """``text -> ids`` (numpy uint32) of a ``tokenizers`` file, with special tokens
    found in texts but none added, no truncation and no padding.

    Plain byte-level files run through ``tiktoken``, which gives the same ids in a
    quarter of the time; any other file through ``tokenizers`` itself.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or []
    plain = (model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
             and not split.get("add_prefix_space") and not spec.get("normalizer")
             and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
             and not any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in added))
    if plain:
        vocab, symbols = model["vocab"], _byte_of_symbol()
        special = {t["content"]: t["id"] for t in added}
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged == sorted(merged) and (not merged or merged[0] >= 256):
            import tiktoken

            ranks = {bytes(symbols[c] for c in token): i for token, i in vocab.items() if token not in special}
            known = tiktoken.Encoding("packing", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens=special)
            return lambda text: known.encode_to_numpy(text, allowed_special="all")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


def _staged(docs: DataFrame, key: Column, text: Column, path: str, end_id: int, capacity: int) -> DataFrame:
    """``part``, ``row``, ``doc_id``, ``doc_tokens``, ``n_full``, ``full_rank`` (whole
    windows of the task before), ``rest`` and ``rest_rank`` (remainders of that
    length before, in the task), ``tokens`` (compressed ids)."""
    rows = docs.select(key.alias("doc_id"), null_to_empty(text).alias("text"))
    fields = [("part", pa.int32()), ("row", pa.int64()), ("doc_tokens", pa.int64()), ("n_full", pa.int64()),
              ("full_rank", pa.int64()), ("rest", pa.int32()), ("rest_rank", pa.int64()), ("tokens", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encode, squeeze = encoder(path), zstandard.ZstdCompressor(level=1).compress
        part, row, full = TaskContext.get().partitionId(), 0, 0
        seen = np.zeros(capacity, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                out = []
                for text_ in some.column(1).to_pylist():
                    ids = np.append(encode(text_), np.uint32(end_id)).astype("<u4")
                    n_full, rest = divmod(len(ids), capacity)
                    out.append((part, row, len(ids), n_full, full, rest, int(seen[rest]), squeeze(ids.tobytes())))
                    row += 1
                    full += n_full
                    seen[rest] += 1
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0), *(pa.array(c, t) for c, (_, t) in zip(zip(*out), fields))],
                        names=["doc_id", *(n for n, _ in fields)])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, part int, row bigint, doc_tokens bigint, n_full bigint, full_rank bigint, "
                                "rest int, rest_rank bigint, tokens binary")


# --- plan ----------------------------------------------------------------

def closest_fill(lengths: list[int], counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The multiset of ``lengths`` (descending), each at most ``counts`` times, whose
    sum comes closest to ``room`` without exceeding it, as (length, times).

    Bit t of ``reach`` says that a multiset of the lengths so far sums to t.  Of
    equal sums, the one that leaves the shorter lengths is taken.
    """
    reach, mask, states = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        times = min(counts[length], room // length)
        if times <= 0:
            continue
        states.append((length, reach))
        step = 1
        while times > 0:
            take = min(step, times)
            reach |= (reach << (take * length)) & mask
            times -= take
            step *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, before in reversed(states):
        times = 0
        while not before >> total & 1:
            total -= length
            times += 1
        if times:
            chosen.append((length, times))
    return chosen[::-1]


@dataclass
class Plan:
    """Steps by (length, first rank): ``keys`` sorted, and per step the copies in a
    sequence, the first sequence, the offset there, the tokens cut off (0: the whole
    remainder) and the length and first rank of what is left of a cut remainder."""
    keys: np.ndarray
    steps: np.ndarray
    n_sequences: int
    padding: int


def make_plan(counts: dict[int, int], capacity: int) -> Plan:
    """Minimum bin slack over the counts of remainders by length."""
    left = {length: n for length, n in counts.items() if n > 0 and length > 0}
    used: dict[int, int] = dict.fromkeys(left, 0)
    rows, sequences, padding = [], 0, 0
    order = sorted(left, reverse=True)
    while order:
        longest = order[0]
        left[longest] -= 1
        chosen = closest_fill(order, left, capacity - longest)
        left[longest] += 1
        need = {longest: 1}
        for length, times in chosen:
            need[length] = need.get(length, 0) + times
        slack = capacity - sum(length * times for length, times in need.items())
        donor = next((x for x in order if left[x] > need.get(x, 0)), None) if slack else None
        repeats = min((left[x] // (times + (x == donor)) for x, times in need.items()))
        if donor is not None and donor not in need:
            repeats = min(repeats, left[donor])
        if donor is None and slack:
            repeats, padding = 1, padding + (0 if (capacity - slack).bit_count() == 1 else slack)
        offset = 0
        for length, times in need.items():
            rows.append((length, used[length], times, sequences, offset, 0, 0, 0))
            used[length] += repeats * times
            left[length] -= repeats * times
            offset += length * times
        if donor is not None:
            rest = donor - slack
            if rest not in used:
                used[rest] = 0
            if left.get(rest, 0) == 0:
                order = sorted({*order, rest}, reverse=True)
            rows.append((donor, used[donor], 1, sequences, offset, slack, rest, used[rest] + left.get(rest, 0)))
            used[donor] += repeats
            left[donor] -= repeats
            left[rest] = left.get(rest, 0) + repeats
        sequences += repeats
        order = [x for x in order if left[x] > 0]
    rows.sort()
    steps = np.array(rows, np.int64).reshape(-1, 8)
    return Plan((steps[:, 0] << _RANK_BITS) | steps[:, 1], steps, sequences, padding)


def places(plan: Plan, length: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Pieces of remainders given by length and rank: (index, start in the remainder,
    tokens, sequence, offset), in rounds: each round has the next piece of those that
    were cut."""
    index, start = np.arange(len(length)), np.zeros(len(length), np.int64)
    length, rank = length.astype(np.int64), rank.astype(np.int64)
    while len(index):
        step = plan.steps[np.searchsorted(plan.keys, (length << _RANK_BITS) | rank, "right") - 1]
        at, times, first, offset, cut = rank - step[:, 1], step[:, 2], step[:, 3], step[:, 4], step[:, 5]
        size = np.where(cut > 0, cut, length)
        yield index, start, size, first + at // times, offset + at % times * length
        more = cut > 0
        index, start = index[more], (start + cut)[more]
        length, rank = step[more, 6], step[more, 7] + at[more]


# --- the job -------------------------------------------------------------

def pack(docs: DataFrame, key: Column, text: Column, tokenizer: str, end_id: int = END_ID,
         capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents: ``doc_id`` (the key), ``start``, ``length``, ``ids``
    (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``.

    ``tokenizer`` is the path of a ``tokenizers`` file that every executor has.
    Every token lies in exactly one piece, and the pieces of a sequence follow one
    another from offset 0 without a gap.  Null and empty texts are the end id alone;
    texts of any length are taken whole (one is held by its task).  Rows with null
    or equal keys are documents of their own, in any number; other columns of
    ``docs`` are not read, whatever their names; an empty table gives no pieces.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = scratch_path(spark, "packing-tokens")
    _staged(docs, key, text, tokenizer, end_id, capacity).write.mode("overwrite").option("compression", "none").parquet(folder)
    staged = spark.read.parquet(folder)
    # Whole windows count as one more length: the capacity itself.
    narrow = staged.select("part", "row", F.explode(F.array(
        F.struct(F.lit(capacity).alias("size"), F.col("n_full").alias("n"), F.col("full_rank").alias("rank")),
        F.struct(F.col("rest").alias("size"), F.when(F.col("rest") > 0, 1).otherwise(0).cast("bigint").alias("n"),
                 F.col("rest_rank").alias("rank")))).alias("x")).select("part", "row", "x.*").where("n > 0")
    counts = narrow.groupBy("part", "size").agg(F.sum("n").alias("n"))
    by_length = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    by_length.pop(capacity, None)
    plan = make_plan(by_length, capacity)
    before = Window.partitionBy("size").orderBy("part")
    first = counts.select("part", "size", (F.sum("n").over(before) - F.col("n")).alias("first"))
    ranked = narrow.join(first, ["part", "size"]).select("part", "row", "size", "n", (F.col("rank") + F.col("first")).alias("rank"))
    entries = ranked.mapInArrow(functools.partial(_entries, plan, capacity),
                                "part int, row bigint, start bigint, size bigint, n bigint, sequence bigint, place bigint")
    parts = entries.groupBy("part", "row").agg(F.collect_list(F.struct("start", "size", "n", "sequence", "place")).alias("pieces"))
    met = staged.select("part", "row", "doc_id", "doc_tokens", "n_full", "tokens").join(parts, ["part", "row"])
    kind = staged.schema["doc_id"].dataType.simpleString()
    return met.select("doc_id", "doc_tokens", "n_full", "tokens", "pieces").mapInArrow(
        functools.partial(_pieces, capacity),
        f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")


def _entries(plan: Plan, capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole windows (``n`` of them in a row) and of remainders, with the first
    sequence and the offset.  ``start`` counts from the remainder's start."""
    names = ["part", "row", "start", "size", "n", "sequence", "place"]
    for batch in batches:
        part, row, size, n, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        whole = size == capacity
        zeros = np.zeros(int(whole.sum()), np.int64)
        found = [(part[whole], row[whole], zeros, zeros + capacity, n[whole], plan.n_sequences + rank[whole], zeros)]
        part, row = part[~whole], row[~whole]
        for index, start, taken, sequence, place in places(plan, size[~whole], rank[~whole]):
            found.append((part[index], row[index], start, taken, np.ones(len(index), np.int64), sequence, place))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=names)


def _pieces(capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    open_ = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            some = batch.slice(lo, 64)
            rows, owner = [], []
            for i, (total, n_full, tokens, pieces) in enumerate(zip(*(some.column(c).to_pylist() for c in range(1, 5)))):
                ids = memoryview(open_(tokens))
                for p in pieces:
                    base = 0 if p["size"] == capacity else n_full * capacity
                    for j in range(p["n"]):
                        start = base + p["start"] + j * capacity
                        rows.append((start, p["size"], bytes(ids[4 * start:4 * (start + p["size"])]), total,
                                     p["sequence"] + j, p["place"]))
                        owner.append(i)
            columns = zip(*rows) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [some.column(0).take(pa.array(owner, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=names)


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``used`` (tokens) and ``ids``, padded
    to the capacity with ``pad_id`` unless ``used`` is a power of two."""
    laid = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("used"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.aggregate("p", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    size = F.when(F.bit_count("used") == 1, F.col("used")).otherwise(F.lit(capacity))
    pad = F.lit(int(pad_id).to_bytes(4, "little"))
    return laid.select("sequence_id", "used", F.rpad(ids, (size * 4).cast("int"), pad).alias("ids"))
