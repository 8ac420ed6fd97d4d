"""Spelling variants: words, signatures, near pairs, forms, defined cases."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import spelling

LETTERS = "abeéÿñ"


def brute_words(rows, min_length=7, min_count=2):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words, ratio=10):
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def sample_words(seed, n=150, letters=LETTERS, sizes=(7, 11)):
    rnd = random.Random(seed)
    words = {}
    while len(words) < n:
        if words and rnd.random() < 0.7:
            w = rnd.choice(list(words))
            i, c = rnd.randrange(len(w)), rnd.choice(letters)
            w = rnd.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]])
        else:
            w = "".join(rnd.choices(letters, k=rnd.randint(*sizes)))
        if len(w) >= sizes[0]:
            words[w] = rnd.choice([2, 2, 3, 5, 30, 400, 5000, 10**5])
    return words


def variants(spark, words, **kw):
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    out = spelling.variants(frame, **kw)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("seed", range(2))
def test_words_one_edit_apart_share_a_signature(seed):
    words = list(sample_words(seed, 400, "abcÀ", (7, 9)))
    found = {w: (set(spelling.signatures(w)), set(spelling.signatures(w, 5, 3)), set(spelling.without_one(w))) for w in words}
    pairs = [p for p in itertools.combinations(words, 2) if one_edit(*p)]
    assert len(pairs) > 200
    for a, b in pairs:
        assert all(x & y for x, y in zip(found[a], found[b])), (a, b)


@pytest.mark.parametrize("seed, limit", [(1, 1000), (2, 1), (3, 4), (4, 0)])
def test_variants_equal_brute_force_for_any_group_limit(spark, seed, limit):
    words = sample_words(seed)
    assert variants(spark, words, group_limit=limit) == brute_variants(words)


def test_crowded_signatures(spark):
    rnd = random.Random(5)
    words = {}
    while len(words) < 300:  # anagrams with one first half: all share every signature of that half
        tail = list("abcdefg")
        rnd.shuffle(tail)
        words["qqqqqqq" + "".join(tail)] = 2
    words |= {w[:-1] + "z": 50 for w in list(words)[:20]}
    assert variants(spark, words, group_limit=20) == brute_variants(words)


def test_chains_end_at_the_root_and_ties_take_the_least_word(spark):
    base = "abcdefghijkl"
    words = {}
    for i in range(12):  # each is one letter from the next, ten times as frequent
        words["z" * i + base[i:] + "qqq"] = 2 * 10**i
    words |= {"xxxxxxxy": 2, "xxxxxxxÿ": 20, "xxxxxxxz": 20, "xxxxxxx": 20}
    got = variants(spark, words)
    assert got == brute_variants(words)
    rows = {r[0]: r for r in got}
    assert {rows["z" * i + base[i:] + "qqq"][2] for i in range(12)} == {"z" * 11 + "lqqq"}
    assert rows["xxxxxxxy"][1] == "xxxxxxx" and rows["xxxxxxxy"][4] == 3


def test_words_of_texts(spark):
    rnd = random.Random(8)
    pool = ["Example", "EXAMPLES", "Ærodynamic", "straßenbahn", "señorita×x", "naïveté÷yes", "sevenix", "eightxyz"]
    rows = [(rnd.choice([None, i, 7]), " ".join(rnd.choices(pool, k=30)) + rnd.choice(["", "Āmixedly", "mixedly\U0001f600", "日本 word"]))
            for i in range(60)] + [(1, None), (2, ""), (3, "a" * 5000 + " " + "a" * 5000)]
    docs = spark.createDataFrame([(i, t, 1, "w") for i, t in rows] , "doc_id bigint, text string, n int, word string")
    got = {r.word: r.n for r in spelling.word_counts(docs, F.col("doc_id"), F.col("text")).collect()}
    assert got == brute_words(rows) and any(len(w) == 5000 for w in got)
    want = brute_variants({w: n for w, n in got.items() if len(w) < 100})
    out = spelling.spelling_variants(docs, F.col("doc_id"), F.col("text")).collect()
    assert sorted(tuple(r) for r in out if len(r.word) < 100) == want


def test_repeated_rows_count_and_empty_tables_give_no_rows(spark):
    docs = spark.createDataFrame([(1, "wonderful")] * 3 + [(1, "wonderfully")], "doc_id bigint, text string")
    assert {r.word: r.n for r in spelling.word_counts(docs, F.col("doc_id"), F.col("text")).collect()} == brute_words(
        [(1, "wonderful")] * 3 + [(1, "wonderfully")])
    assert spelling.spelling_variants(docs.limit(0), F.col("doc_id"), F.col("text")).count() == 0
