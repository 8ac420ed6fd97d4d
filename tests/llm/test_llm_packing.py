"""Packing into sequences: plan, pieces, defined cases."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import packing
from cartwheel.llm.catalog import QUERIES, tokenizer_path
from cartwheel.llm.common import read_table
from conftest import SF_SMALL

BYTE_LEVEL = "byte_bpe_50k.json"


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(BYTE_LEVEL))


def padding(totals, capacity):
    return sum(0 if int(t).bit_count() == 1 else capacity - int(t) for t in totals)


def check_pieces(rows, want, capacity):
    """``rows`` (key, start, ids, sequence, offset) hold every token of ``want``
    (key -> ids) once, and sequences are gapless; returns the sequences' totals."""
    documents, sequences = {}, {}
    for key, start, ids, sequence, offset in rows:
        documents.setdefault(key, []).append((start, ids))
        sequences.setdefault(sequence, []).append((offset, len(ids)))
    assert documents.keys() == want.keys()
    for key, parts in documents.items():
        parts.sort(key=lambda p: p[0])
        assert [s for s, _ in parts] == [0, *itertools.accumulate(len(i) for _, i in parts)][:-1]
        assert [t for _, i in parts for t in i] == want[key]
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *itertools.accumulate(n for _, n in parts)][:-1]
        assert 0 < sum(n for _, n in parts) <= capacity
    return [sum(n for _, n in parts) for parts in sequences.values()]


def brute_fill(lengths, room):
    return max(s for n in range(len(lengths) + 1) for s in map(sum, itertools.combinations(lengths, n)) if s <= room)


@pytest.mark.parametrize("seed", range(30))
def test_closest_fill_is_the_best_subset_sum(seed):
    rnd = random.Random(seed)
    lengths = [rnd.randint(1, 40) for _ in range(rnd.randint(0, 11))]
    counts = {x: lengths.count(x) for x in lengths}
    room = rnd.randint(0, 90)
    chosen = packing.closest_fill(sorted(counts, reverse=True), counts, room)
    assert all(0 < times <= counts[x] for x, times in chosen) and len({x for x, _ in chosen}) == len(chosen)
    assert sum(x * times for x, times in chosen) == brute_fill(lengths, room)


@pytest.mark.parametrize("capacity, counts", [
    (64, {}), (64, {5: 1}), (64, {63: 40}), (64, {32: 3}), (64, {40: 1000, 1: 3}), (64, {33: 10, 34: 7, 35: 1}),
    (64, {x: 1 + x % 7 for x in range(1, 64)}), (2048, {1100: 30_000}), (2048, {700: 5000, 1: 3, 1500: 800}),
])
def test_plan_places_every_remainder_and_leaves_one_sequence_open(capacity, counts):
    plan = packing.make_plan(counts, capacity)
    length = np.concatenate([np.full(n, x) for x, n in counts.items()] or [np.zeros(0, int)])
    rank = np.concatenate([np.arange(n) for n in counts.values()] or [np.zeros(0, int)])
    rows = [(int(i), int(s), [(int(i), int(s) + k) for k in range(n)], int(q), int(o))
            for found in packing.places(plan, length, rank) for i, s, n, q, o in zip(*found)]
    totals = check_pieces(rows, {i: [(i, k) for k in range(n)] for i, n in enumerate(length.tolist())}, capacity)
    assert len(totals) == plan.n_sequences and sum(t < capacity for t in totals) <= 1
    assert padding(totals, capacity) == plan.padding


def test_encoder_equals_the_library():
    encode, tokenizer = packing.encoder(tokenizer_path(BYTE_LEVEL)), library()
    rnd = random.Random(7)
    points = [c for c in range(0x32000) if not 0xD800 <= c <= 0xDFFF] + [*range(0xE0000, 0xE0200), 0x10FFFF]
    texts = ["".join(f"a{chr(c)}b 1{chr(c)} {chr(c)}\n" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    texts += ["".join(rnd.choice("ab 'sétX1.,\n\t　\U0001f600<|>") for _ in range(rnd.randint(0, 80))) for _ in range(500)]
    texts += ["", " ", "<|endoftext|>", "x <|endoftext|><|endoftext|> y", "don't we'LL", "a" * 30_000, " " * 30_000]
    for text, known in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert encode(text).tolist() == known.ids, text[:40]


def test_other_tokenizer_files_go_through_the_library():
    from tokenizers import Tokenizer

    path = tokenizer_path()
    assert packing.encoder(path)("Some words").tolist() == Tokenizer.from_file(path).encode("Some words", add_special_tokens=False).ids


def test_query_packs_every_token_of_the_table(spark):
    tokenizer = library()
    out = QUERIES["op11_packing"](spark, SF_SMALL).collect()
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    want = {d.doc_id: tokenizer.encode(d.text or "", add_special_tokens=False).ids + [1] for d in docs}
    for r in out:
        ids = np.array(want[r.doc_id][r.start:r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids.tobytes()) and r.doc_tokens == len(want[r.doc_id])
    rows = [(r.doc_id, r.start, want[r.doc_id][r.start:r.start + r.length], r.sequence_id, r.offset) for r in out]
    totals = check_pieces(rows, want, 2048)
    assert sum(t < 2048 for t in totals) <= 1


def test_defined_cases(spark):
    long = "many words of one very long text " * 3000
    rows = [(1, None, 7, "a"), (1, "", 7, "b"), (None, "one two", 7, "c"), (None, "one two", 7, "c"), (2, long, 7, "d"), (3, "x", 7, "e")]
    docs = spark.createDataFrame(rows * 2, "doc_id bigint, text string, start int, part string")
    out = packing.pack(docs, F.col("doc_id"), F.col("text"), tokenizer_path(BYTE_LEVEL)).collect()
    ids_of = lambda r: np.frombuffer(bytes(r.ids), "<u4").tolist()
    assert all(len(r.ids) == 4 * r.length for r in out)
    assert sum(r.length for r in out) == sum(len(library().encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _, _ in rows * 2)
    alone = [ids_of(r) for r in out if r.doc_id == 1]
    assert alone == [[1]] * 4
    assert sorted(ids_of(r) for r in out if r.doc_id is None)[0][-1] == 1
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sorted(p)[0][0] == 0 for p in sequences.values())
    empty = packing.pack(docs.limit(0), F.col("doc_id"), F.col("text"), tokenizer_path(BYTE_LEVEL))
    assert empty.count() == 0 and empty.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def test_sequences_hold_their_pieces_and_padding(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 50)) for i in range(60)], "doc_id bigint, text string")
    pieces = packing.pack(docs, F.col("doc_id"), F.col("text"), tokenizer_path(BYTE_LEVEL), capacity=64).cache()
    rows = pieces.collect()
    for s in packing.sequences(pieces, 64, pad_id=9).collect():
        own = sorted((r.offset, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in rows if r.sequence_id == s.sequence_id)
        ids = [t for _, part in own for t in part]
        assert s.used == len(ids)
        size = len(ids) if len(ids).bit_count() == 1 else 64
        assert np.frombuffer(bytes(s.ids), "<u4").tolist() == ids + [9] * (size - len(ids))
