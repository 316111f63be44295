"""Token-ID binary output: independent zstandard frames with a trailing seek table.

File format (one file per range of doc_ids, names in ascending order):

* one zstandard frame per document: its ids, little-endian, 2 or 4 bytes each
  (4 where the vocabulary needs it); each frame carries zstandard's own checksum;
* an index in a skippable frame (magic 0x184D2A50): magic "TOKS", version, bytes
  per id, documents; then for each document: has an id (1 byte), doc_id (8), ids (8);
* the seek table of zstandard's seekable format in the last skippable frame
  (magic 0x184D2A5E): compressed size, plain size and the low 32 bits of the
  plain bytes' XXH64 for each frame, then the number of frames, a descriptor
  byte and the magic 0x8F92EAB1.

A reader takes the table from the end of the file and decompresses only the
frames of the documents it wants.  Any zstandard tool still unpacks the file.

Writing: documents are dealt by ranges of doc_id and sorted, so files follow
each other in doc_id order; a task writes to a name of its own and renames at
the end, so a repeated or doubled task leaves one whole file.  Spark returns
only the list of files.

Encoding: the whole text goes through the tokenizers library.  Where the
tokenizer drops white space and marks the end of each word, words are
independent of each other; then each worker encodes a word once and reuses its
ids (a bounded cache).

Defined results: null text counts as empty (its frame holds the end id alone);
null doc_ids come first; equal doc_ids are ordered by a hash of the text; an
empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
import public_tokenizers
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoleaf.llm.common import shuffle_partitions, small_batches, table
from chronoleaf.session import materialize, scratch_dir

FILE_BYTES = 64 << 20          # text in one file, about
CACHE_WORDS = 1_000_000         # words whose ids a worker keeps
END_ID = 1
# fixed values of the zstandard formats
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1


_COMMA, _STOP = re.compile(rb",(?<=[a-z],)"), re.compile(rb"\.(?<=[a-z]\.)")
_COMBINING = re.compile(rb"\xcc|\xcd[\x80-\xaf]")   # U+0300 to U+036F


class Encoder:
    """ids of whole texts as the tokenizers library gives them, special tokens not added."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = (spec["model"].get("end_of_word_suffix") or "")
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        split = steps[0] if steps else {}
        # words are independent where the first step keeps only matches of a pattern that white space never enters
        self.by_word = bool(suffix and split.get("type") == "Split" and split.get("invert")
                            and split.get("behavior") == "Removed" and "\\s" in split["pattern"].get("Regex", ""))
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        # case and the place between a letter and a comma or full stop do not matter: fewer distinct words
        self.folds = self.by_word and self._ids(["Ab, cD."]) == self._ids(["ab , cd ."])
        if self.by_word:
            self.piece = regex.compile(split["pattern"]["Regex"])
            self.ends = np.zeros(self.tok.get_vocab_size(), bool)
            for token, i in self.tok.get_vocab().items():
                self.ends[i] = token.endswith(suffix)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, word: str) -> int:
        return len(self.piece.findall(self.tok.normalizer.normalize_str(word) if self.tok.normalizer else word))

    def _learn(self, words: list[bytes]) -> None:
        """Encode unknown words many at a time, and part the ids by the words' own pieces."""
        texts = [w.decode() for w in words]
        # beyond these letters the two regular-expression libraries might differ; such words go alone
        simple = [len(t) < 200 and (t.isascii() or max(t) < "ɐ") for t in texts]
        plain = [(w, t) for w, t, ok in zip(words, texts, simple) if ok]
        odd = [(w, t) for w, t, ok in zip(words, texts, simple) if not ok]
        for at in range(0, len(plain), 512):
            own, said = zip(*plain[at:at + 512])
            ids = np.array(self.tok.encode_batch_fast([" ".join(said)], add_special_tokens=False)[0].ids, np.int64)
            cut = np.flatnonzero(self.ends[ids]) + 1
            pieces = np.cumsum([1 if t.isalpha() else self._pieces(t) for t in said])
            if len(cut) != pieces[-1] or (len(cut) and cut[-1] != len(ids)):
                odd += zip(own, said)
                continue
            stop = (np.append(0, cut)[pieces] * self.width).tolist()
            raw = ids.astype(self.kind).tobytes()
            self.cache.update(zip(own, [raw[i:j] for i, j in zip([0, *stop], stop)]))
        for (w, _), ids in zip(odd, self._ids([t for _, t in odd])):
            self.cache[w] = ids

    def _words(self, text: bytes) -> list[bytes]:
        if self.folds and not _COMBINING.search(text):   # a mark may compose with a small letter only
            text = _STOP.sub(b" .", _COMMA.sub(b" ,", text.lower()))
        return text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text, ``width`` bytes each."""
        if not self.by_word:
            return self._ids(texts)
        parts = [self._words(t.encode("utf-8", "replace")) for t in texts]
        if len(self.cache) > CACHE_WORDS // 2:            # words in use come back from the older half
            self.cache, self.older = {}, self.cache
        new = set().union(*parts).difference(self.cache)
        self.cache.update((w, self.older[w]) for w in new if w in self.older)
        self._learn([w for w in new if w not in self.cache])
        return [b"".join(map(self.cache.__getitem__, p)) for p in parts]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def skippable(magic: int, payload: bytes) -> bytes:
    return struct.pack("<II", magic, len(payload)) + payload


class TokenFileWriter:
    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.packer = zstandard.ZstdCompressor(level=1, write_checksum=True)
        self.seek, self.docs, self.tokens = [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.packer.compress(ids)
        self.out.write(frame)
        self.seek.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        n = len(ids) // self.width
        self.docs.append((doc_id is not None, doc_id or 0, n))
        self.tokens += n

    def close(self) -> None:
        known, ids, n = zip(*self.docs) if self.docs else ((), (), ())
        index = (b"TOKS" + struct.pack("<HHQ", 1, self.width, len(self.docs)) + np.array(known, "<u1").tobytes()
                 + np.array(ids, "<i8").tobytes() + np.array(n, "<u8").tobytes())
        self.out.write(skippable(SKIPPABLE_INDEX, index))
        table_ = np.array(self.seek, "<u4").reshape(-1, 3).tobytes()
        self.out.write(skippable(SKIPPABLE_SEEK, table_ + struct.pack("<IBI", len(self.seek), 0x80, SEEKABLE)))


class TokenFile:
    """Random access to a token file through its seek table."""

    def __init__(self, file):
        self.file, size = file, file.size()
        frames, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError("no seek table at the end of the file")
        length = 12 * frames + 9
        head = struct.unpack("<II", self._read(size - length - 8, 8))
        if head != (SKIPPABLE_SEEK, length):
            raise ValueError("damaged seek table")
        seek = np.frombuffer(self._read(size - length, 12 * frames), "<u4").reshape(-1, 3)
        self.sizes, self.plain, self.sums = (seek[:, i].astype(np.int64) for i in range(3))
        self.offset = np.append(0, np.cumsum(self.sizes))
        end = int(self.offset[-1])
        magic, length = struct.unpack("<II", self._read(end, 8))
        index = self._read(end + 8, length)
        if magic != SKIPPABLE_INDEX or index[:4] != b"TOKS":
            raise ValueError("no index after the frames")
        _, self.width, n = struct.unpack_from("<HHQ", index, 4)
        known = np.frombuffer(index, "<u1", n, 16)
        ids = np.frombuffer(index, "<i8", n, 16 + n).tolist()
        self.doc_ids = [d if k else None for d, k in zip(ids, known)]
        self.lengths = np.frombuffer(index, "<u8", n, 16 + 9 * n).astype(np.int64)
        self.unpacker = zstandard.ZstdDecompressor()

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(n)
        if len(data) != n:
            raise ValueError("the file ends too early")
        return data

    def _plain(self, i: int, frame: bytes) -> np.ndarray:
        data = self.unpacker.decompress(frame) if self.plain[i] else b""
        if len(data) != self.plain[i] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[i]:
            raise ValueError(f"frame {i} does not match its checksum")
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def document(self, i: int) -> np.ndarray:
        """ids of the i-th document; nothing else is read or decompressed."""
        return self._plain(i, self._read(int(self.offset[i]), int(self.sizes[i])))

    def documents(self, at_once: int = 4 << 20) -> Iterator[tuple[int | None, np.ndarray]]:
        i = 0
        while i < len(self.sizes):
            j = max(i + 1, int(np.searchsorted(self.offset, self.offset[i] + at_once, "right")) - 1)
            data, base = self._read(int(self.offset[i]), int(self.offset[j] - self.offset[i])), self.offset[i]
            for k in range(i, j):
                yield self.doc_ids[k], self._plain(k, data[self.offset[k] - base:self.offset[k + 1] - base])
            i = j


def write_token_files(docs: DataFrame, out_dir: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into token files below ``out_dir``; returns file, docs, tokens, start."""
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(shuffle_partitions(spark), math.ceil(size / FILE_BYTES))

    def write(batches):
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.kind).tobytes()
        part = TaskContext.get().partitionId()
        fs, root = open_fs(out_dir)
        name, own = f"{root}/part-{part:06d}.tok", f"{root}/.part-{part:06d}.{uuid.uuid4().hex}"
        writer = None
        for pdf in batches:
            if writer is None:
                fs.create_dir(root)
                writer = TokenFileWriter(fs.open_output_stream(own), enc.width)
            unknown = pdf["unknown"].tolist()
            for d, u, ids in zip(pdf["doc_id"].tolist(), unknown, enc.encode(pdf["text"].tolist())):
                writer.add(None if u else d, ids + end)
        if writer is not None:
            writer.close()
            writer.out.close()
            fs.move(own, name)
            yield pd.DataFrame({"part": [part], "file": [f"{out_dir}/part-{part:06d}.tok"],
                                "docs": [len(writer.docs)], "tokens": [writer.tokens]})

    rows = docs.select(F.col("doc_id").isNull().alias("unknown"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63)).alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    ranged = rows.repartitionByRange(files, "doc_id").sortWithinPartitions(
        F.desc("unknown"), "doc_id", F.xxhash64("text"), "text")
    listed = materialize(ranged.mapInPandas(write, "part int, file string, docs long, tokens long"), "token-files")
    # one row per file, so the running total is over a short list
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return listed.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, ids (packed, 4 bytes each, little-endian) of every document of the listed files."""

    def read(batches):
        for pdf in batches:
            for name, start in zip(pdf["file"], pdf["start"].tolist()):
                fs, path = open_fs(name)
                held, size = [], 0
                with fs.open_input_file(path) as f:
                    for d, ids in TokenFile(f).documents():
                        held.append((d is None, d or 0, start, ids.tobytes()))
                        start += len(ids)
                        size += 4 * len(ids)
                        if size > 8 << 20:
                            yield pd.DataFrame(held, columns=["unknown", "doc_id", "start", "ids"])
                            held, size = [], 0
                yield pd.DataFrame(held, columns=["unknown", "doc_id", "start", "ids"]).astype(
                    {"unknown": bool, "doc_id": "int64", "start": "int64"})

    spark = files.sparkSession
    rows = files.select("file", "start").repartition(shuffle_partitions(spark) * 4, "file").mapInPandas(
        read, "unknown boolean, doc_id long, start long, ids binary")
    return rows.select(F.when(~F.col("unknown"), F.col("doc_id")).alias("doc_id"), "start", "ids")


def op7_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_token_files(table(spark, sf_dir, "documents").select("doc_id", "text"),
                              scratch_dir(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(files).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
