"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a word the last token of its encoding is unique.  The
vocabulary tokens that end at a position come from an Aho-Corasick automaton
(its suffix links list all tokens that are suffixes of the prefix).  A token
``t`` is the last token of a prefix exactly if it is a token that encodes to
itself and the pair (last token of the rest, ``t``) is compatible: no merge
that has priority would have joined the two across their border.  The ids are
read off by following the back-pointers from the end of the word.

Words recur, so a worker keeps the ids of words and of white-space separated
chunks in tables of bounded size; the result does not depend on them.
"""

from __future__ import annotations

import json
import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import null_to_empty, per_text, per_worker
from cartwheel.session import ship_package

# Unicode White_Space, written out because regular-expression libraries differ in ``\s``.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f"[^{_SPACE}]+")
# Categories in which Unicode versions differ: unassigned code points, and marks with
# their combining classes (those up to U+036F are old).
_UNSURE = frozenset(("Cn", "Mn", "Mc", "Me"))
# Private-use area that holds the symbols which end a word.
_END = 0xE000
SCHEMA_TAIL = "ids binary, decoded string"


class _Table(dict):
    """Values computed on first use, kept up to a bound."""

    def __init__(self, compute, bound: int):
        super().__init__()
        self.compute, self.bound = compute, bound

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) < self.bound and len(key) <= 64:
            self[key] = value
        return value


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in out:
            out[b], extra = chr(extra), extra + 1
    return [out[b] for b in range(256)]


class Codec:
    """Encoder and decoder for one tokenizer file (BPE model with word ends,
    NFC / white-space / lower-case normalisers, a removing split, byte level)."""

    def __init__(self, spec: str, cache: int = 300_000):
        import ahocorasick
        import regex

        doc = json.loads(spec)
        self._spec, self._library = spec, None
        model = doc["model"]
        suffix = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or not suffix or model.get("continuing_subword_prefix"):
            raise ValueError("a BPE model with an end-of-word suffix is needed")
        kinds = [n["type"] for n in doc["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unsupported normalisers {kinds}")
        split = doc["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        pattern = regex.compile(split.replace(r"[^\s", f"[^{_SPACE}"))
        self._pieces = pattern.findall
        self._special = {t["content"]: t["id"] for t in doc["added_tokens"]}
        self._special_split = re.compile(
            "(" + "|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) + ")").split
        self.tokens = {i: t for t, i in model["vocab"].items()} | {
            i: t for t, i in self._special.items()}

        symbols = byte_symbols()
        self._bytes = symbols
        number = {s: b for b, s in enumerate(symbols)}

        def inner(token: str) -> str:
            """The token with its word end folded into its last symbol."""
            if token.endswith(suffix):
                body = token[:-len(suffix)]
                return body[:-1] + chr(_END + number[body[-1]])
            return token

        ids = {inner(t): i for t, i in model["vocab"].items()}
        self._final = [chr(_END + b) for b in range(256)]
        # Rank of a merge, and for each merged token the pair it came from.
        self._rank: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int]] = {}
        self._rank_of: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, (list, tuple)) else pair.split(" ")
            left, right = ids[inner(a)], ids[inner(b)]
            whole = ids[inner(a) + inner(b)]
            self._rank[left, right] = rank
            self._parts.setdefault(whole, (left, right))
            self._rank_of.setdefault(whole, rank)
        self._compatible = _PairTable(self._pair_ok, 400_000)
        self._automaton = ahocorasick.Automaton()
        for text, i in sorted(ids.items(), key=lambda x: len(x[0])):
            if i not in self._parts and len(text) > 1:
                continue  # no merge builds it
            if len(text) > 1 and not self._builds(i):
                continue
            self._automaton.add_word(text, (len(text), i))
        self._automaton.make_automaton()
        self._packed = {i: i.to_bytes(4, "little") for i in self.tokens}
        self._words = _Table(self._word, cache)
        self._chunks = _Table(self._chunk, cache)

    def _pair_ok(self, pair: tuple[int, int]) -> bool:
        """Whether two adjacent tokens stay apart.

        Undo the merges of both tokens from the latest to the earliest.  At each
        step the symbols at the border are the ones that existed side by side;
        if a merge of them comes before the one that was undone last, it would
        have taken place instead.
        """
        left, right = pair
        limit = len(self._rank) + 1
        while True:
            rank = self._rank.get((left, right))
            if rank is not None and rank < limit:
                return False
            l_rank, r_rank = self._rank_of.get(left, -1), self._rank_of.get(right, -1)
            if l_rank < 0 and r_rank < 0:
                return True
            if l_rank > r_rank:
                # On the left side an equal rank would act first (left to right).
                limit, left = l_rank, self._parts[left][1]
            else:
                limit, right = r_rank + 1, self._parts[right][0]

    def _builds(self, token: int) -> bool:
        """Whether the token's own text encodes to this one token."""
        a, b = self._parts[token]
        return self._pair_split_ok(a, b, self._rank_of[token])

    def _pair_split_ok(self, left: int, right: int, limit: int) -> bool:
        """As ``_pair_ok``, but for merges earlier than ``limit`` only."""
        while True:
            l_rank, r_rank = self._rank_of.get(left, -1), self._rank_of.get(right, -1)
            if l_rank < 0 and r_rank < 0:
                return True
            if l_rank > r_rank:
                limit, left = l_rank, self._parts[left][1]
            else:
                limit, right = r_rank + 1, self._parts[right][0]
            rank = self._rank.get((left, right))
            if rank is not None and rank < limit:
                return False

    def _word(self, piece: str) -> bytes:
        """Packed ids of one piece of normalised text."""
        raw = piece.encode("utf-8")
        word = "".join([self._bytes[b] for b in raw[:-1]]) + self._final[raw[-1]]
        n = len(word)
        last = [-1] * (n + 1)  # last token of each prefix
        size = [0] * (n + 1)
        ok = self._compatible
        for end, (length, token) in self._automaton.iter(word):
            i = end + 1
            if last[i] < 0:  # the last token is unique: the first hit settles the prefix
                j = i - length
                if j == 0 or (last[j] >= 0 and ok[last[j], token]):
                    last[i], size[i] = token, length
        out, i = [], n
        while i > 0:
            out.append(self._packed[last[i]])
            i -= size[i]
        out.reverse()
        return b"".join(out)

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return self._words[chunk.lower()]
        if not any(s in chunk for s in self._special):
            return self._plain(chunk)
        return b"".join([self._packed[self._special[part]] if part in self._special else self._plain(part)
                         for part in self._special_split(chunk)])

    def _plain(self, text: str) -> bytes:
        if not text.isascii() and max(text) > "\u036f" and any(unicodedata.category(c) in _UNSURE for c in text):
            pieces = self._by_library(text)
        else:
            # Lower-casing goes character by character: no final-sigma rule.
            pieces = self._pieces(unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower())
        return b"".join(map(self._words.__getitem__, pieces))

    def _by_library(self, text: str) -> list[str]:
        """Pieces of a text with code points on which Unicode versions differ: the
        library's own tables normalise and split it."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self._spec)
        whole = self._library.normalizer.normalize_str(text)
        return [whole[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(whole)]

    def encode(self, text: str) -> bytes:
        """Ids of a text as packed little-endian unsigned 32-bit integers."""
        return b"".join(map(self._chunks.__getitem__, _CHUNK.findall(text)))

    def decode(self, ids: bytes) -> str:
        """Tokens of packed ids joined by one space (the file names no decoder)."""
        import numpy as np

        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _PairTable(_Table):
    def __missing__(self, key):
        value = self.compute(key)
        if len(self) < self.bound:
            self[key] = value
        return value


_CODECS: dict[int, Codec] = {}


def codec(spec: str) -> Codec:
    """The codec of a tokenizer file's content, built once in a worker process."""
    key = hash(spec)
    if key not in _CODECS:
        _CODECS[key] = Codec(spec)
    return _CODECS[key]


def encode_texts(df: DataFrame, tokenizer_path: str, key: Column, text: Column,
                 key_type: str = "bigint") -> DataFrame:
    """Rows ``(doc_id, ids binary, decoded string)``, one for each input row.

    ``ids`` are packed little-endian unsigned 32-bit integers; ``decoded`` is
    made from them.  A null text counts as empty: no ids, empty decoding.
    Repeated rows and null keys are encoded like any other row; other columns
    of ``df`` are ignored, whatever their names.  An empty table gives an empty
    result.  The tokenizer file (a few MB, never data) is read on the driver
    and sent to the workers by a broadcast variable.
    """
    spark = df.sparkSession
    ship_package(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    @per_worker
    def start():
        c = codec(spec.value)

        def one(doc_id, body):
            ids = c.encode(body)
            return doc_id, ids, c.decode(ids)
        return one

    return per_text(df, [key.alias("doc_id"), null_to_empty(text).alias("text")], start,
                    f"doc_id {key_type}, {SCHEMA_TAIL}", rows_per_batch=64)


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and SHA-256 digests of ``encode_texts``' rows."""
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
