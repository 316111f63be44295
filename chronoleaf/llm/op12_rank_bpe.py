"""BPE encoding and decoding with contiguous rank arrays.

A text is split into words by the tokenizer's pattern, and every distinct word
is merged once per worker (a bounded cache keeps its ids).  A short word is an
array of parts, held as the ids between its boundaries, beside an array of the
ranks of adjacent parts.  The merge loop scans the ranks for the least (the
leftmost of equal ones), deletes the boundary between the two parts by closing
the gap, and looks up only the two ranks beside the joined part, until no rank
is left.  Many words of about the same length take each step together, a row of
a NumPy block each.  For the few words beyond SHORT_BYTES, where scanning would
be quadratic, the same merges come from a heap of ranks over linked parts.

Ranks belong to pairs of ids, as in the tokenizer file's list of merges.  Texts
over PART_CHARS are cut before white space that follows other characters, which
no match of the pattern spans.  The pattern runs in the ``regex`` module; parts
that hold a character which Python's Unicode tables do not know are split by the
tokenizers library itself, as the two engines may class such characters
differently.  A special token's string in a text gives its id, as the library
does by default; ``special_as_text=True`` makes it ordinary text.

Decoding joins the bytes of the ids' tokens and reads them as UTF-8, each
maximal broken sequence becoming U+FFFD; unknown ids are left out and special
tokens kept, as the library does.

Only files of this kind are taken: BPE with byte-level splitting and decoding,
no normalizer, no prefix space, no dropout, no continuation marks.

Defined results: null text counts as empty and gives no ids; null ids decode to
the empty string; an empty table gives no rows; rows are independent of each
other, so repeats and ties need no rule.  ``encode_texts`` and ``decode_ids``
replace columns named like their result; other columns pass through.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoleaf.llm.common import small_batches, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN     # of the byte-level pre-tokenizer
SHORT_BYTES = 48
BLOCK_WORDS = 4096        # short words merged together
CACHE_WORDS = 200_000     # words whose ids a worker keeps
PART_CHARS = 1 << 16
_NONE = np.int32(2**31 - 1)
_SAFE = regex.compile(r"(?<=\S)(?=\s)")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level token files: printable Latin-1 characters for themselves,
    the others, in order, the code points from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class RankBpe:
    def __init__(self, path: str, special_as_text: bool = False):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        if (model.get("type") != "BPE" or split.get("type") != "ByteLevel" or not split.get("use_regex", True)
                or split.get("add_prefix_space") or (spec.get("decoder") or {}).get("type") != "ByteLevel"
                or spec.get("normalizer") or any(model.get(k) for k in (
                    "dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))):
            raise ValueError("not a plain byte-level BPE file")
        vocab, letters = model["vocab"], byte_letters()
        self.byte_id = np.array([vocab[c] for c in letters], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.key_rank = key[order], order.astype(np.int32)
        self.joined = np.array([vocab[a + b] for a, b in pairs], np.int32)     # by rank
        self.rank_of = dict(zip(key.tolist(), range(len(pairs))))
        byte_of = {c: bytes([i]) for i, c in enumerate(letters)}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = {i: b"".join(byte_of[c] for c in t) for t, i in vocab.items() if t not in special}
        self.bytes_of |= {i: t.encode() for t, i in special.items()}
        self.special = {} if special_as_text else special
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) \
            if self.special else None
        self.pattern = regex.compile(PATTERN)
        self.known: set[str] = set()
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.path, self.library = path, None

    # --- merging

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of parts; none where a part is missing (-1) or no merge joins them."""
        want = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where((self.key[at] == want) & (left >= 0) & (right >= 0), self.key_rank[at], _NONE)

    def merge_block(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of short words of about one length: one row of parts and one of ranks for each word."""
        n, width = len(words), max(map(len, words))
        length = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        column = np.arange(width + 1)
        parts = np.full((n, width + 1), -1, np.int32)            # one column stays empty: the end of the longest word
        parts[:, :width] = np.where(column[:width] < length[:, None], self.byte_id[raw], -1)
        ranks = self.ranks(parts[:, :-1], parts[:, 1:])
        out, live = parts.copy(), np.arange(n)
        while len(live):
            at = ranks.argmin(axis=1)                            # the first of the least ranks
            row = np.arange(len(live))
            least = ranks[row, at]
            more = least != _NONE
            if not more.all():
                done = ~more
                out[live[done]] = -1
                out[live[done], :parts.shape[1]] = parts[done]
                live, parts, ranks, at, least = live[more], parts[more], ranks[more], at[more], least[more]
                row = row[:len(live)]
                if not len(live):
                    break
            parts[row, at] = self.joined[least]
            # the boundary after ``at`` goes: later parts and ranks move up by one
            later = column[1:parts.shape[1] - 1] > at[:, None]
            parts[:, 1:-1] = np.where(later, parts[:, 2:], parts[:, 1:-1])
            parts[:, -1] = -1
            ranks[:, :-1] = np.where(column[:ranks.shape[1] - 1] >= at[:, None], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = _NONE
            ranks[row, at] = self.ranks(parts[row, at], parts[row, at + 1])
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.ranks(parts[before, at[before] - 1], parts[before, at[before]])
            parts, ranks = parts[:, :-1], ranks[:, :-1] if ranks.shape[1] > 1 else ranks
            if parts.shape[1] < 2:
                out[live] = -1
                out[live, :1] = parts
                break
        count = (out >= 0).sum(axis=1)
        packed, stop = out[out >= 0].astype("<u4").tobytes(), np.cumsum(count) * 4
        return [packed[a:b] for a, b in zip([0, *stop[:-1].tolist()], stop.tolist())]

    def merge_long(self, word: bytes) -> bytes:
        """The same merges for a long word: the least rank from a heap, parts in a linked list."""
        part = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(part)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        rank_of, size, joined = self.rank_of, self.size, self.joined.tolist()
        heap = [(r, i) for i in range(n - 1) if (r := rank_of.get(part[i] * size + part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if part[i] < 0 or j < 0 or rank_of.get(part[i] * size + part[j]) != rank:
                continue                                         # the pair is gone
            part[i], part[j] = joined[rank], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if (r := rank_of.get(part[i] * size + part[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank_of.get(part[h] * size + part[i])) is not None:
                heapq.heappush(heap, (r, h))
        return np.array([p for p in part if p >= 0], "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        short = sorted(((w.encode("utf-8", "replace"), w) for w in words if len(w) <= SHORT_BYTES), key=lambda p: len(p[0]))
        for at in range(0, len(short), BLOCK_WORDS):
            block = short[at:at + BLOCK_WORDS]
            self.cache.update(zip((w for _, w in block), self.merge_block([b for b, _ in block])))

    # --- texts

    def words(self, text: str) -> list[str]:
        if not text.isascii() and (new := set(text) - self.known):
            good = {c for c in new if unicodedata.category(c) != "Cn"}
            self.known |= good
            if good != new:
                if self.library is None:
                    from tokenizers import Tokenizer
                    self.library = Tokenizer.from_file(self.path)
                spans = self.library.pre_tokenizer.pre_tokenize_str(text)
                return [text[a:b] for _, (a, b) in spans]
        return self.pattern.findall(text)

    def parts(self, text: str) -> list[str]:
        out, at = [], 0
        while len(text) - at > PART_CHARS:
            m = _SAFE.search(text, at + PART_CHARS)
            if not m:
                break
            out.append(text[at:m.start()])
            at = m.start()
        return [*out, text[at:]]

    def pieces(self, text: str):
        """Words (strings) and special ids (packed) of a text in order."""
        at = 0
        for m in self.specials.finditer(text) if self.specials else ():
            for part in self.parts(text[at:m.start()]):
                yield self.words(part)
            yield [np.array([self.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        for part in self.parts(text[at:] if at else text):
            yield self.words(part)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids (little-endian, 4 bytes each) of each text."""
        if len(self.cache) > CACHE_WORDS // 2:                   # words in use come back from the older half
            self.cache, self.older = {}, self.cache
        split = [[w for part in self.pieces(t) for w in part] for t in texts]
        new = {w for w in set().union(*split).difference(self.cache) if isinstance(w, str)}
        self.cache.update((w, self.older[w]) for w in new if w in self.older)
        self.learn([w for w in new if w not in self.cache])
        cache = self.cache

        def ids(w) -> bytes:
            found = cache.get(w)
            return found if found is not None else w if isinstance(w, bytes) else self.merge_long(w.encode("utf-8", "replace"))

        out = []
        for words in split:
            try:
                out.append(b"".join(map(cache.__getitem__, words)))
            except KeyError:                                     # a long word or a special token
                out.append(b"".join(map(ids, words)))
        return out

    def decode(self, ids) -> str:
        get = self.bytes_of.get
        return b"".join([get(i, b"") for i in ids]).decode("utf-8", "replace")


_loaded: dict[tuple[str, bool], RankBpe] = {}


def loaded(path: str, special_as_text: bool) -> RankBpe:
    if (path, special_as_text) not in _loaded:
        _loaded[path, special_as_text] = RankBpe(path, special_as_text)
    return _loaded[path, special_as_text]


def encode_texts(docs: DataFrame, path: str, text_col: str = "text", to: str = "ids", special_as_text: bool = False) -> DataFrame:
    """Adds the texts' ids as array<int>."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def encode(col: pd.Series) -> pd.Series:
        packed = loaded(path, special_as_text).encode(col.tolist())
        return pd.Series([np.frombuffer(p, "<i4") for p in packed], dtype=object)

    return docs.withColumn(to, encode(F.coalesce(F.col(text_col), F.lit(""))))


def decode_ids(docs: DataFrame, path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """Adds the text that the ids (array<int>) stand for."""

    @F.pandas_udf("string")
    def decode(col: pd.Series) -> pd.Series:
        own = loaded(path, False)
        return pd.Series([own.decode(np.asarray(ids).tolist()) for ids in col], dtype=object)

    return docs.withColumn(to, decode(F.coalesce(F.col(ids_col), F.array().cast("array<int>"))))


def op12_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER)
    back = decode_ids(coded.select("doc_id", "ids"), TOKENIZER)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
