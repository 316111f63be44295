"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

A long text is cut at safe boundaries first: between a character that is not
white space and one that is.  No match of the split pattern spans such a place
(white space stands only at the start of a match that holds anything else), so
the parts' ids joined are the whole text's ids.  A stretch without a safe
boundary that is still long (one giant word, or a giant run of white space) is
cut into the pattern's own matches, each encoded by itself, which keeps the
library's pattern engine off inputs it cannot handle.

Decoding joins the bytes of the ids' tokens; it never goes through text, so ids
that end inside a character come back byte for byte.

Ids travel packed: little-endian unsigned 32-bit integers in a binary column.

Defined results: null text counts as empty and gives no ids; unpaired
surrogates cannot occur in Spark strings; an empty table gives no rows.
``encode_texts`` and ``decode_ids`` replace columns named like their result;
other columns pass through.
"""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoleaf.llm.common import small_batches, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
PART_CHARS = 1 << 16      # longer texts are cut at safe boundaries
_SAFE = regex.compile(r"(?<=\S)(?=\s)")


class Bpe:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token

    def parts(self, text: str) -> list[str]:
        """The text cut at safe boundaries into parts of about PART_CHARS."""
        out, at = [], 0
        while len(text) - at > PART_CHARS:
            m = _SAFE.search(text, at + PART_CHARS)
            if not m:
                break
            out.append(text[at:m.start()])
            at = m.start()
        out.append(text[at:])
        return out

    def encode(self, text: str) -> np.ndarray:
        ids: list[int] = []
        for part in self.parts(text):
            if len(part) <= 2 * PART_CHARS:
                ids += self.encoding.encode_ordinary(part)
            else:
                for m in self.pattern.finditer(part):
                    ids += self.encoding._encode_single_piece(m[0])
        return np.array(ids, "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


_loaded: dict[tuple[str, str], Bpe] = {}


def bpe(path: str, pattern: str) -> Bpe:
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Bpe(path, pattern)
    return _loaded[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str, text_col: str = "text", to: str = "ids") -> DataFrame:
    small_batches(docs.sparkSession)

    @F.pandas_udf("binary")
    def encode(col: pd.Series) -> pd.Series:
        own = bpe(path, pattern)
        return col.map(lambda t: own.encode(t).tobytes()).astype(object)

    return docs.withColumn(to, encode(F.coalesce(F.col(text_col), F.lit(""))))


def decode_ids(docs: DataFrame, path: str, pattern: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    @F.pandas_udf("binary")
    def decode(col: pd.Series) -> pd.Series:
        own = bpe(path, pattern)
        return col.map(lambda b: own.decode(np.frombuffer(b, "<u4"))).astype(object)

    return docs.withColumn(to, decode(F.coalesce(F.col(ids_col), F.lit(b""))))


def round_trip(docs: DataFrame, path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the bytes they decode to."""
    back = decode_ids(encode_texts(docs.select("doc_id", "text"), path, pattern), path, pattern)
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
