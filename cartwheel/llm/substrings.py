"""Removal of repeated word sequences, by fixed-block anchors.

A window of ``window`` words repeats if the same sequence also starts earlier
(smaller document, or earlier in the same document).  With blocks of half a
window, laid without overlap from the start of each document, every window
holds a whole block.  The job has three rounds over *chunks* of documents, which
hold a bounded number of bytes:

1. Anchors.  Each chunk sends the hashes of its blocks and of all its rolling
   windows of block length, each value once, dealt out by hash.  A block that
   a second position probes is a hit; the answer is one bit for each block.
2. Extension.  A window can only repeat if all blocks inside it are hits.  The
   chunk sends the 128-bit hashes of those windows, each value once, at its
   first place; the earliest place of a value is the original, all others are
   repeats.
3. Runs of repeated windows are maximal exact repeats; their words go.

No pairs of places are formed: a sequence that occurs in n chunks makes n
entries.  Hashes travel sorted, as differences in byte planes, which the shuffle
compresses to about two bytes for each word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import null_to_empty, shuffle_partitions
from cartwheel.session import checkpoint_dir, ship_package

WINDOW = 20
# Text bytes of a chunk and entries that one bucket of hashes holds, about.
CHUNK_BYTES = 4 << 20
BUCKET_ENTRIES = 3 << 20
_KEY_BITS = 30
_NULL_ID = (1 << 63) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolling(words: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of every ``size`` consecutive word hashes (polynomial, then mixed)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    factor = np.uint64(base)
    for k in range(size):
        out *= factor
        out += words[k:k + n]
    return _mixed(out)


_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Chunk:
    """The words of a chunk's documents, in the order that decides what is earlier."""

    def __init__(self, table: pa.Table, window: int):
        import xxhash

        self.window, self.block = window, window // 2
        ids = table.column("doc_id").to_pylist()
        ties = table.column("_tie").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (_NULL_ID if ids[i] is None else ids[i], ids[i] is None, ties[i]))
        self.ids = [ids[i] for i in order]
        self.ties = np.array([ties[i] for i in order], np.int64)
        text = table.column("text")
        self.words: list[bytes] = []
        sizes = []
        for i in order:
            found = text[i].as_buffer().to_pybytes().split()  # ASCII white space
            sizes.append(len(found))
            self.words += found
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        self.doc = np.repeat(np.arange(len(self.ids)), self.sizes)

    def places(self, size: int) -> np.ndarray:
        """Starts of all runs of ``size`` words in documents that hold a window."""
        at = np.arange(max(len(self.words) - size + 1, 0))
        doc = self.doc[:len(at)]
        return at[(self.starts[doc + 1] - at >= size) & (self.sizes[doc] >= self.window)]

    def anchors(self, buckets: int):
        """Distinct (bucket, key) of the rolling block-length windows, sorted, with
        whether a value occurs twice and whether it is a block; and, for each
        block, its place and the index of its value."""
        at = self.places(self.block)
        h = rolling(self.hashes, self.block, _BASES[0])[at]
        key = ((h >> np.uint64(34)) % np.uint64(buckets)).astype(np.int64) << _KEY_BITS
        key |= (h & np.uint64((1 << _KEY_BITS) - 1)).astype(np.int64)
        values, index, counts = np.unique(key, return_inverse=True, return_counts=True)
        is_block = (at - self.starts[self.doc[at]]) % self.block == 0
        blocks = np.zeros(len(values), bool)
        blocks[index[is_block]] = True
        return values, counts > 1, blocks, at[is_block], index[is_block]


def _pack(sorted_values: np.ndarray) -> bytes:
    """Ascending 32-bit values as byte planes of their differences."""
    steps = np.diff(sorted_values.astype(np.int64), prepend=0).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
    return np.cumsum(steps, dtype=np.int64)


_ANCHORS = "_chunk int, bucket int, payload binary"
_WINDOWS = "_chunk int, bucket int, docs binary, runs binary, hashes binary, places binary, known binary"
_ANSWER = "_chunk int, bucket int, payload binary"
_RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept string"
_ARROW = {
    _ANCHORS: pa.schema([("_chunk", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())]),
    _WINDOWS: pa.schema([("_chunk", pa.int32()), ("bucket", pa.int32()),
                         *((n, pa.binary()) for n in ("docs", "runs", "hashes", "places", "known"))]),
    _RESULT: pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept", pa.string())]),
}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    arrow = _ARROW[schema]
    columns = list(zip(*rows)) if rows else [[] for _ in arrow]
    return pa.table([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _send_anchors(window: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        number = table.column("_chunk")[0].as_py()
        values, twice, blocks, _, _ = Chunk(table, window).anchors(buckets)
        entry = ((values & ((1 << _KEY_BITS) - 1)) << 2) | (twice.astype(np.int64) << 1) | blocks
        cuts = np.searchsorted(values, np.arange(buckets + 1, dtype=np.int64) << _KEY_BITS)
        return _table([(number, b, _pack(entry[cuts[b]:cuts[b + 1]])) for b in range(buckets)
                       if cuts[b + 1] > cuts[b]], _ANCHORS)
    return send


def _match_anchors(table: pa.Table) -> pa.Table:
    """For each chunk's blocks in this bucket, one bit: does another place have it?"""
    chunks, bucket = table.column("_chunk").to_pylist(), table.column("bucket")[0].as_py()
    parts = [_unpack(p.as_buffer().to_pybytes()) for p in table.column("payload")]
    entry = np.concatenate(parts)
    order = np.argsort(entry >> 2, kind="stable")
    key = entry[order] >> 2
    first = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.cumsum(first) - 1
    starts = np.flatnonzero(first)
    times = np.add.reduceat(1 + ((entry[order] >> 1) & 1), starts)
    block = np.maximum.reduceat(entry[order] & 1, starts)
    hit = np.empty(len(entry), bool)
    hit[order] = ((times > 1) & (block > 0))[group]
    out, at = [], 0
    for chunk, part in zip(chunks, parts):
        own = hit[at:at + len(part)][(part & 1) > 0]
        at += len(part)
        if own.any():
            out.append((chunk, bucket, np.packbits(own).tobytes()))
    return _table(out, _ANCHORS)


def _send_windows(window: int, buckets: int):
    def send(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows or not answers.num_rows:
            return _table([], _WINDOWS)
        chunk = Chunk(docs, window)
        values, _, blocks, block_at, block_index = chunk.anchors(buckets)
        # The answer's bits belong to the bucket's block values in ascending order.
        hit = np.zeros(len(values), bool)
        cuts = np.searchsorted(values, np.arange(buckets + 1, dtype=np.int64) << _KEY_BITS)
        for bucket, bits in zip(answers.column("bucket").to_pylist(), answers.column("payload").to_pylist()):
            own = np.flatnonzero(blocks[cuts[bucket]:cuts[bucket + 1]]) + cuts[bucket]
            hit[own] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(own)).astype(bool)
        # Windows all of whose blocks are hits.
        n = len(chunk.words)
        missed = np.zeros(n + 1, np.int64)
        missed[block_at + 1] = ~hit[block_index]
        missed = np.cumsum(missed)
        at = chunk.places(window)
        at = at[missed[at + window - chunk.block + 1] == missed[at]]
        if not len(at):
            return _table([], _WINDOWS)
        a, b = (rolling(chunk.hashes, window, base)[at] for base in _BASES)
        order = np.lexsort((at, b, a))
        first = np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])
        known = np.sort(at[order[~first]])  # the same sequence starts earlier in this chunk
        keep = np.sort(order[first])
        at, a, b = at[keep], a[keep], b[keep]
        number = docs.column("_chunk")[0].as_py()
        out = [(number, number % buckets, b"", b"", b"", b"", _pack(known))] if len(known) else []
        target = ((a >> np.uint64(34)) % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(target, kind="stable")
        cuts = np.searchsorted(target[by], np.arange(buckets + 1))
        doc_ids = np.array([_NULL_ID if i is None else i for i in chunk.ids], np.int64)
        for bucket in range(buckets):
            own = by[cuts[bucket]:cuts[bucket + 1]]
            if len(own):
                doc, runs = np.unique(chunk.doc[at[own]], return_counts=True)
                out.append((number, bucket, np.stack([doc_ids[doc], chunk.ties[doc]]).tobytes(),
                            runs.astype("<u4").tobytes(), np.stack([a[own], b[own]]).tobytes(), _pack(at[own]), b""))
        return _table(out, _WINDOWS)
    return send


def _match_windows(table: pa.Table) -> pa.Table:
    """Places of the windows that have an earlier place, by chunk."""
    bucket = table.column("bucket")[0].as_py()
    rows = table.select(["_chunk", "docs", "runs", "hashes", "places", "known"]).to_pylist()
    out = [(r["_chunk"], bucket, r["known"]) for r in rows if r["known"]]
    rows = [r for r in rows if r["hashes"]]
    if rows:
        runs = [np.frombuffer(r["runs"], "<u4") for r in rows]
        docs = [np.frombuffer(r["docs"], np.int64).reshape(2, -1) for r in rows]
        ids, ties = (np.concatenate([np.repeat(d[k], n) for d, n in zip(docs, runs)]) for k in (0, 1))
        a, b = (np.concatenate([np.frombuffer(r["hashes"], np.uint64).reshape(2, -1)[k] for r in rows]) for k in (0, 1))
        order = np.lexsort((ties, ids, b, a))
        later = np.zeros(len(a), bool)
        later[order[1:]] = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        at = 0
        for r in rows:
            places = _unpack(r["places"])
            own = places[later[at:at + len(places)]]
            at += len(places)
            if len(own):
                out.append((r["_chunk"], bucket, _pack(own)))
    return _table(out, _ANCHORS)


def _remove(window: int):
    def remove(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _table([], _RESULT)
        chunk = Chunk(docs, window)
        edge = np.zeros(len(chunk.words) + 1, np.int64)
        for payload in answers.column("payload").to_pylist():
            places = _unpack(payload)
            edge[places] += 1
            edge[places + window] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        out = []
        for i, doc_id in enumerate(chunk.ids):
            lo, hi = int(chunk.starts[i]), int(chunk.starts[i + 1])
            words, cut = chunk.words[lo:hi], gone[lo:hi]
            removed = int(cut.sum())
            if removed:
                words = [words[k] for k in np.flatnonzero(~cut)]
            out.append((doc_id, hi - lo, removed, b" ".join(words).decode("utf-8")))
        return _table(out, _RESULT)
    return remove


def remove_repeats(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES,
                   bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """Rows ``(doc_id, n_words, n_removed, kept)``, one for each row of ``docs``.

    Words are runs of anything but ASCII white space, unchanged.  Every word that
    a window covers whose sequence also starts earlier goes; ``kept`` holds the
    others, joined by one space.  Windows are judged on the input.  A null text
    has no words; texts shorter than a window stay whole.  Rows that share an id
    follow each other by a hash of their texts, null ids come last, repeated
    rows count as separate documents: all after the first lose what they repeat, in
    any number.  Texts of any length are read whole.  Other columns are ignored; an empty table
    gives an empty result.  ``window`` is even and at least 2.
    """
    spark = docs.sparkSession
    ship_package(spark)
    checkpoint_dir(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), null_to_empty(F.col("text")).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
    rows, copies = _without_copies(rows, window)
    # How much there is decides only how finely chunks and buckets are cut.
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = shuffle_partitions(spark)
    chunks = max(2 * parts, -(-size // chunk_bytes))
    buckets = max(parts, -(-size // (5 * bucket_entries)))
    rows = rows.select("*", F.pmod(F.xxhash64("doc_id", "_tie"), F.lit(chunks)).cast("int").alias("_chunk"))
    by_chunk = rows.groupBy("_chunk")
    anchors = by_chunk.applyInArrow(_send_anchors(window, buckets), _ANCHORS)
    hits = anchors.groupBy("bucket").applyInArrow(_match_anchors, _ANSWER)
    windows = by_chunk.cogroup(hits.groupBy("_chunk")).applyInArrow(_send_windows(window, buckets), _WINDOWS)
    repeats = windows.groupBy("bucket").applyInArrow(_match_windows, _ANSWER)
    kept = by_chunk.cogroup(repeats.groupBy("_chunk")).applyInArrow(_remove(window), _RESULT)
    return kept if copies is None else kept.unionByName(copies)


def _without_copies(rows: DataFrame, window: int) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` with the first of equal rows only, and the results of the others, if any.

    Every window of a copy also starts in the first one, so a copy of a window's length
    or more loses all its words, and no other row's result depends on it.
    """
    numbered = rows.withColumn("_id", F.monotonically_increasing_id())
    repeated = numbered.groupBy("doc_id", "_tie").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first")).where(
        "_n > 1").select(F.col("doc_id").alias("_doc"), F.col("_tie").alias("_same"), "_first").checkpoint()
    if repeated.limit(1).count() == 0:
        return rows, None
    met = numbered.join(repeated, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_tie") == F.col("_same")), "left")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    copies = met.where("_first IS NOT NULL AND _id <> _first").select("doc_id", words.alias("_w"))
    n = F.size("_w").cast("bigint")
    whole = n < window
    return met.where("_first IS NULL OR _id = _first").select(*rows.columns), copies.select(
        "doc_id", n.alias("n_words"), F.when(whole, F.lit(0).cast("bigint")).otherwise(n).alias("n_removed"),
        F.when(whole, F.array_join("_w", " ")).otherwise(F.lit("")).alias("kept"))
