"""Phrase collocation mining over a prefix-free parse.

Parsing: a document's words (pieces between punctuation apart) are cut where the
hash of the next ``max_words - 1`` words hits a residue, so equal passages are
cut alike wherever they stand.  A chunk runs from one cut over the next one's
trigger words; neighbouring chunks overlap by these words.  The dictionary holds
each distinct chunk of a language once, with its frequency in the parse.

Counting: phrases are counted inside the distinct chunks, weighted by frequency.
A phrase belongs to the chunk where it starts, and the trigger words at a chunk's
end start nothing there, so an overlap is counted once; a phrase never reaches
beyond them.  Chunks without a trigger for LONGEST words are cut there, which
changes no count.

What can reach the threshold is found first: blocks of the dictionary send the
hashes of their words and word pairs (32 bits beside the segment they are dealt
to, and a count that stops at the threshold) and each segment keeps those whose
hashes together reach it, a superset of the frequent ones.  They come back as a
bit map of at most FILTER_BITS bits (64 MB, whatever the input; more hashes than
it can tell apart only let more through).  Then the words and pairs that pass,
and longer phrases all of whose shorter ones pass, are counted exactly, by their
text.  Within a block, occurrences meet by 64-bit hashes and their bytes are
compared.

Scores are exact decimals.  The first phrases of a language are picked among
equal shares of its phrases before they meet, so a language that holds most of
the corpus does not gather in one task.

Defined results: null text counts as empty, null lang as ``und``; a language
without words gives no rows; repeated rows count each; ties are broken by the
count, then the phrase in byte order; an empty table gives no rows; counts over
10^13 raise; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoleaf.llm import words as W
from chronoleaf.llm.common import small_batches, table
from chronoleaf.session import materialize

MAX_WORDS, LEAST, TOP = 3, 10, 2000
CHUNK_WORDS = 32          # words between triggers, on average
LONGEST = 512             # words of a chunk without a trigger
BLOCK_BYTES = 6 << 20     # of the dictionary counted together
SEGMENT_WORDS = 1 << 21   # of the corpus for each segment of hashes
FILTER_BITS = 29          # of the greatest bit map, as a power of two
COUNT = "decimal(13,0)"

# fixed values of the contract: separators of words and of pieces
_BLANK, _PIECE = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"


def _byte_set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_WORD, _BREAK = ~_byte_set(_BLANK + _PIECE), _byte_set(_PIECE)
_CHUNK_WORD = ~_byte_set(b" \n")


def _joined(buf: bytes, start: np.ndarray, end: np.ndarray, after: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words with one byte (``after``) behind each, and their new places."""
    size = end - start + 1
    at = np.cumsum(size) - size
    source, parts = np.frombuffer(buf, np.uint8), []
    for lo in range(0, len(start), 1 << 18):
        hi = min(lo + (1 << 18), len(start))
        n = size[lo:hi]
        part = source[np.repeat(start[lo:hi] - (at[lo:hi] - at[lo]), n) + np.arange(n.sum())]
        part[at[lo:hi] - at[lo] + n - 1] = after[lo:hi]
        parts.append(part.tobytes())
    return b"".join(parts), at


def chunks(texts: list[bytes], max_words: int, chunk_words: int = CHUNK_WORDS) -> tuple[list[bytes], list[int], list[int]]:
    """The parse of lower-case ``texts``: chunks, the words that start a phrase in each, and the text each is of.
    Words are joined by a space, pieces by a line end; a chunk ends in one if the text ends with it."""
    buf = b"\n".join(texts) + b"\n"
    start, end = W.spans(buf, _WORD)
    if not len(start):
        return [], [], []
    own = W.owners(np.array([len(t) for t in texts]), start)
    seen = np.cumsum(_BREAK[np.frombuffer(buf, np.uint8)])[start]
    last = np.append(own[1:] != own[:-1], True)                      # of its text
    after = np.where(last | np.append(seen[1:] != seen[:-1], True), 10, 32).astype(np.uint8)
    h = W.run_hashes(W.word_hashes(buf, start, end), max_words - 1)  # of the trigger words from each place
    whole = own[:len(h)] == own[max_words - 2:][:len(h)]             # which lie in one text
    cut = np.zeros(len(start), bool)
    cut[:len(h)] = whole & (W.mix(h) % np.uint64(chunk_words) == 0)
    cut[0] = True
    cut[1:] |= last[:-1]
    first = np.flatnonzero(cut)
    gap = np.diff(np.append(first, len(start)))
    if (gap > LONGEST).any():
        more = np.concatenate([np.arange(f + LONGEST, f + g, LONGEST) for f, g in zip(first, gap) if g > LONGEST])
        more = more[more < len(h)]
        cut[more[whole[more]]] = True
        first = np.flatnonzero(cut)
    stop = np.append(first[1:], len(start))                          # words that start a phrase end here
    open_ = ~last[stop - 1]
    text, at = _joined(buf, start, end, after)
    final = np.where(open_, stop + max_words - 2, stop - 1)
    upto = at[final] + (end - start)[final] + ~open_                 # a text's last chunk keeps its line end
    return ([text[a:b] for a, b in zip(at[first].tolist(), upto.tolist())], (stop - first).tolist(), own[first].tolist())


def parse(docs: DataFrame, max_words: int = MAX_WORDS, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The dictionary: lang, chunk, words (that start a phrase in it), n (its frequency), written."""
    small_batches(docs.sparkSession)

    def cut(batches):
        for pdf in batches:
            texts = [t.encode("utf-8", "replace").lower() for t in pdf["text"]]     # bytes: A-Z only
            found, words, own = chunks(texts, max_words)
            lang = pdf["lang"].tolist()
            seen = Counter(zip((lang[i] for i in own), found, words))
            if seen:
                keys, n = zip(*seen.keys()), list(seen.values())
                yield pd.DataFrame(dict(zip(("lang", "chunk", "words"), map(list, keys))) | {"n": n})

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text"))
    parsed = rows.mapInPandas(cut, "lang string, chunk binary, words int, n long")
    return materialize(parsed.groupBy("lang", "chunk", "words").agg(F.sum("n").alias("n")), "phrase-chunks")


class _Block:
    """Chunks of the dictionary as arrays over their words."""

    def __init__(self, pdf: pd.DataFrame):
        texts = pdf["chunk"].tolist()
        self.buf = b"\n".join(texts) + b"\n"
        self.start, self.end = W.spans(self.buf, _CHUNK_WORD)
        own = W.owners(np.array([len(t) for t in texts]), self.start)
        self.n = pdf["n"].to_numpy(np.int64)[own]
        place = np.arange(len(own)) - np.searchsorted(own, own)
        self.starts = place < pdf["words"].to_numpy()[own]
        self.lang, self.langs = pd.factorize(pdf["lang"])
        seeds = np.array([xxhash.xxh64_intdigest(x.encode()) for x in self.langs], np.uint64)
        self.lang = self.lang[own]
        self.joined = np.frombuffer(self.buf, np.uint8)[np.maximum(self.start - 1, 0)] == 32   # to the word before
        self.h = W.mix(W.word_hashes(self.buf, self.start, self.end) + seeds[self.lang]) if len(own) else np.zeros(0, np.uint64)

    def phrases(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places with a phrase of ``size`` words, those in a chunk's trigger words included, and its hash."""
        runs = W.run_hashes(self.h, size)
        ok = np.ones(len(runs), bool)
        for i in range(1, size):
            ok &= self.joined[i:i + len(runs)]
        at = np.flatnonzero(ok)
        return at, W.mix(runs[at] + np.uint64(size))


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[_Block]:
    held, size = [], 0
    for pdf in batches:
        held.append(pdf)
        size += sum(map(len, pdf["chunk"])) + len(pdf)
        if size >= BLOCK_BYTES:
            yield _Block(pd.concat(held, ignore_index=True))
            held, size = [], 0
    if size:
        yield _Block(pd.concat(held, ignore_index=True))


def _summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h)
    h, n = h[order], n[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, int)
    return h[first], (np.add.reduceat(n, first) if len(first) else n)


def frequent_filter(dictionary: DataFrame, least: int) -> tuple[bytes, int]:
    """A bit map that holds the hashes of all words and word pairs with at least ``least`` occurrences (and some
    others), and its size as a power of two."""
    total = dictionary.agg(F.sum(F.col("words").cast("long"))).first()[0] or 0
    deal = max(4, min(18, (total // SEGMENT_WORDS).bit_length()))         # segments, as a power of two

    def send(batches):
        for b in _blocks(batches):
            parts = [(h[b.starts[at]], b.n[at[b.starts[at]]]) for at, h in (b.phrases(size) for size in (1, 2))]
            h, n = _summed(*map(np.concatenate, zip(*parts)))
            low = (h >> np.uint64(32 - deal)).astype("<u4")
            once, n = n == 1, np.minimum(n, least).astype(np.uint32)
            edges = np.searchsorted(h, np.arange(1, 1 << deal, dtype=np.uint64) << np.uint64(64 - deal))
            rows = []
            for s, (lo, hi) in enumerate(zip([0, *edges], [*edges, len(h)])):
                if hi > lo:
                    k, one, c = low[lo:hi], once[lo:hi], n[lo:hi]
                    rows.append((s, k[one].tobytes(), k[~one].tobytes(), c[~one].astype("<u4").tobytes()))
            if rows:
                yield pd.DataFrame(rows, columns=["segment", "single", "several", "n"])

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        single, several, n = (np.frombuffer(b"".join(pdf[c]), "<u4") for c in ("single", "several", "n"))
        h, n = _summed(np.concatenate([single, several]), np.concatenate([np.ones(len(single), np.int64), n.astype(np.int64)]))
        h = h[n >= least]
        return pd.DataFrame({"segment": pdf["segment"].iloc[:1], "n": [len(h)], "hashes": [h.tobytes()]})

    sent = dictionary.mapInPandas(send, "segment int, single binary, several binary, n binary")
    kept = materialize(sent.groupBy("segment").applyInPandas(keep, "segment int, n long, hashes binary"), "phrase-hashes")
    many = kept.agg(F.sum("n")).first()[0] or 0
    bits = max(deal + 3, min(FILTER_BITS, (8 * many).bit_length()))

    def draw(batches):
        for pdf in batches:
            out = []
            for raw in pdf["hashes"]:
                flags = np.zeros(1 << (bits - deal), bool)
                flags[np.frombuffer(raw, "<u4") >> np.uint32(32 - (bits - deal))] = True
                out.append(np.packbits(flags, bitorder="little").tobytes())
            yield pd.DataFrame({"segment": pdf["segment"], "drawn": out})

    size = 1 << (bits - deal - 3)
    whole = bytearray(1 << (bits - 3))
    for r in kept.select("segment", "hashes").mapInPandas(draw, "segment int, drawn binary").toLocalIterator():
        whole[r.segment * size:(r.segment + 1) * size] = r.drawn      # 2^bits bits in all, at most 64 MB
    return bytes(whole), bits


def count_phrases(dictionary: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST) -> DataFrame:
    """lang, phrase (space-joined), size (words), a (occurrences): every phrase of at most ``max_words`` words with
    at least ``least`` occurrences, counted exactly; written."""
    drawn, bits = frequent_filter(dictionary, least)
    shared = dictionary.sparkSession.sparkContext.broadcast(drawn)

    def emit(batches):
        flags = np.frombuffer(shared.value, np.uint8)
        for b in _blocks(batches):
            view, passed = W.lanes(b.buf), None
            for size in range(1, max_words + 1):
                at, h = b.phrases(size)
                if size <= 2:
                    bit = h >> np.uint64(64 - bits)
                    good = (flags[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                else:
                    good = passed[at] & passed[at + 1]           # both phrases one word shorter
                at, h = at[good], h[good]
                if size > 1:
                    passed = np.zeros(len(b.h) + 1, bool)
                    passed[at] = True
                at, h = at[b.starts[at]], h[b.starts[at]]
                if not len(at):
                    continue
                u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
                like = at[first][inverse]
                length, other = b.end[at + size - 1] - b.start[at], b.end[like + size - 1] - b.start[like]
                odd = (length != other) | (b.lang[at] != b.lang[like])
                odd[~odd] = ~W.same_bytes(view, b.start[at][~odd], b.start[like][~odd], length[~odd])
                n = np.bincount(inverse[~odd], b.n[at][~odd], len(u))
                if (n >= 2 ** 52).any():                          # beyond exact floats
                    n = np.zeros(len(u), np.int64)
                    np.add.at(n, inverse[~odd], b.n[at][~odd])
                at = np.concatenate([at[first], at[odd]])         # unlike ones of one hash go alone
                n = np.concatenate([n.astype(np.int64), b.n[at[len(u):]]])
                yield pd.DataFrame({
                    "lang": b.langs.take(b.lang[at]), "size": np.int32(size), "a": n,
                    "phrase": [b.buf[s:e].decode("utf-8", "replace")
                               for s, e in zip(b.start[at].tolist(), b.end[at + size - 1].tolist())]})

    found = dictionary.mapInPandas(emit, "lang string, size int, a long, phrase string")
    return materialize(found.groupBy("lang", "phrase", "size").agg(F.sum("a").alias("a")).where(F.col("a") >= least),
                       "phrase-counts")


def score(counts: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of the phrases of two words and more: the lowest-scoring cut, ties to the first.
    A phrase inside a longer one at least half as frequent is dropped."""
    words = F.split("phrase", " ")
    many = counts.where("size > 1").select("lang", "phrase", "size", "a", words.alias("w"))
    cuts = many.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("first"),
        F.array_join(F.expr("slice(w, k + 1, size(w) - k)"), " ").alias("rest"))
    part = counts.select("lang", "phrase", "a")
    left = part.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = part.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    met = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    a, l, r = (F.col(c).cast(COUNT) for c in "alr")
    met = met.withColumns({"top": F.lit(1_000_000).cast("decimal(7,0)") * (a * a), "bottom": l * r})
    best = met.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(F.expr("top div bottom").alias("score"), "k", "l", "r")).alias("b"))
    inner = (many.where("size > 2").select("lang", "a", "w", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("m"))
             .select("lang", "a", "w", "m", F.explode(F.expr("sequence(1, size - m + 1)")).alias("i"))
             .select("lang", F.col("a").alias("longer"), F.array_join(F.expr("slice(w, i, m)"), " ").alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    return (best.join(inner, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * 50))
            .select("lang", "phrase", "a", "b.l", "b.r", "b.score"))


def first_of_each(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language, ranked; picked in 64 shares first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    near = (scored.withColumn("share", share)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
            .where(F.col("rank") <= top).drop("share", "rank"))
    return (near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    dictionary = parse(table(spark, sf_dir, "documents").select("lang", "text"))
    counts = count_phrases(dictionary)
    n = dictionary.groupBy("lang").agg(F.sum(F.col("words") * F.col("n")).alias("n"))
    return first_of_each(score(counts), TOP).join(n, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP11_SQL = r"""
WITH pieces AS (
  SELECT lang, [x for x in regexp_split_to_array(piece, '[\x20\x09]+') if x <> ''] AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)]) AS phrase
  FROM pieces, (VALUES (1), (2), (3)) s(k) WHERE len(w) >= k
), f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 10),
c AS MATERIALIZED (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS MATERIALIZED (
  SELECT lang, phrase, k, a, j, lang || '|' || array_to_string(w[1:j], ' ') AS first, lang || '|' || array_to_string(w[j + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c)
), part AS MATERIALIZED (SELECT lang || '|' || phrase AS part, a FROM f),
lefts AS MATERIALIZED (SELECT cut.*, part.a AS l FROM cut JOIN part ON part.part = cut.first),
cuts AS (
  SELECT x.lang, x.phrase, x.k, x.a, x.l, part.a AS r, x.j,
    CAST(CAST(1000000 AS HUGEINT) * x.a * x.a // (CAST(x.l AS HUGEINT) * part.a) AS BIGINT) AS score
  FROM lefts x JOIN part ON part.part = x.rest
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE k = 3) GROUP BY lang, phrase
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i USING (lang, phrase)
  WHERE b.k = 3 OR i.longer IS NULL OR 100 * i.longer < 50 * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang)
QUALIFY rank <= 2000
"""
