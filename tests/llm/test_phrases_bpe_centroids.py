"""Operators 11 to 13 against brute force and on odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chronoleaf.llm import op11_phrases as op11
from chronoleaf.llm import op12_rank_bpe as op12
from chronoleaf.llm import op13_centroids as op13


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- op11


def brute_phrases(docs, least, top):
    """(lang, rank, phrase, a, l, r, n, score), counted piece by piece."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang, low = lang or "und", (text or "").encode().lower().decode()
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    often = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = []
    for (lang, w), a in often.items():
        cuts = [(1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        longer = [b for (g, v), b in often.items() if g == lang and len(v) > len(w)
                  and any(v[i:i + len(w)] == w for i in range(len(v)))]
        if not any(100 * b >= 50 * a for b in longer):
            out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    seen, ranked = Counter(), []
    for r in out:
        seen[r[0]] += 1
        if seen[r[0]] <= top:
            ranked.append((r[0], seen[r[0]], *r[1:]))
    return ranked


def mined(spark, docs, least, top=2000, extra=""):
    df = spark.createDataFrame(docs, "lang string, text string" + extra)
    dictionary = op11.parse(df)
    n = {r.lang: r.n for r in dictionary.selectExpr("lang", "words * n AS n").groupBy("lang").sum("n")
         .withColumnRenamed("sum(n)", "n").collect()}
    got = op11.first_of_each(op11.score(op11.count_phrases(dictionary, least=least)), top).collect()
    return sorted(((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, n[r.lang], r.score) for r in got),
                  key=lambda r: (r[0], r[1]))


def phrase_documents(seed, n=150):
    rng = random.Random(seed)
    vocab = ["a", "b", "New", "york", "É", "ß", "x y", "\0", "w" * 70, "c."]
    passage = "the quick brown fox, jumps over\tthe lazy dog\nNew York city hall " * 3
    docs = [(rng.choice(["en", "de", None, "und"]),
             " ".join(rng.choice(vocab) + rng.choice(["", "", ",", "\n", "  "]) for _ in range(rng.randrange(60)))
             + (passage if rng.random() < .3 else "")) for _ in range(n)]
    return docs + [("en", None), ("en", ""), ("xx", " \t.,\n"), ("en", "same " * 1500), (None, "w" * 200_000 + " a a"),
                   *docs[:20], *docs[:20]]


@pytest.mark.parametrize("seed, least", [(1, 3), (2, 10)])
def test_phrases_equal_brute_force(spark, seed, least):
    docs = phrase_documents(seed)
    want = brute_phrases(docs, least, 50)
    assert len(want) > 20
    assert mined(spark, docs, least, 50) == want


def test_phrases_of_an_empty_table_and_clashing_names(spark):
    assert mined(spark, [], 2) == []
    docs = [("en", "go to it. go to it", "k")] * 6
    assert mined(spark, docs, 2, extra=", chunk string") == brute_phrases([d[:2] for d in docs], 2, 2000)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab,. \n"), max_size=400), min_size=1, max_size=5), st.integers(1, 6))
def test_chunks_start_every_word_once_and_overlap_by_the_trigger(texts, every):
    texts = [t.encode() for t in texts]
    found, starts, own = op11.chunks(texts, 3, every)
    for i, t in enumerate(texts):
        words = re.findall(rb"[^ \n.,]+", t)
        again = []
        for c, s, o in zip(found, starts, own):
            if o == i:
                w = c.split()
                assert len(w) == s + (0 if c.endswith(b"\n") else 2)
                again += w[:s]
        assert again == words


def test_long_stretches_without_a_trigger_are_cut(spark):
    text = b" ".join(b"w%d" % i for i in range(5000))
    found, starts, _ = op11.chunks([text], 3, 10 ** 9)
    assert max(starts) == op11.LONGEST and sum(starts) == 5000
    assert op11.chunks([b"same " * 3000], 3)[1].count(1) in (0, 2998)


def test_a_full_filter_only_lets_more_through(spark, monkeypatch):
    docs = phrase_documents(3)
    monkeypatch.setattr(op11, "FILTER_BITS", 4)
    assert mined(spark, docs, 3, 30) == brute_phrases(docs, 3, 30)


# --- op12


LIBRARY = Tokenizer.from_file(op12.TOKENIZER)
OWN = op12.RankBpe(op12.TOKENIZER)
LETTERS = [*"abcdehilnorstuv  \n\t',!?0123", "é", "ß", "漢", "😀", "́", "　", "\x85", "\x1c", "᠎", "​",
           "՘", "꟎", "<|endoftext|>", " the", "'ll", "ing"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(LETTERS), max_size=80).map("".join), max_size=4))
def test_rank_arrays_give_the_librarys_ids(texts):
    for text, ids in zip(texts, OWN.encode(texts)):
        ids = np.frombuffer(ids, "<u4").tolist()
        assert ids == LIBRARY.encode(text, add_special_tokens=False).ids
        assert OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 50300) | st.integers(0, 255), max_size=12))
def test_any_ids_decode_like_the_library(ids):
    assert OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_short_and_long_words_and_very_long_texts():
    n = op12.SHORT_BYTES
    texts = ["a" * k for k in (1, n - 1, n, n + 1, 5000)] + ["é" * n, "漢字" * 400, "ab" * 3000, " " * 3000 + "x", "x" + "\n" * 3000,
             "some words of a text " * 20_000, "x" * 100_000 + " y", "<|endoftext|>" * 3]
    for text, ids in zip(texts, OWN.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    for w in ["tokenization", "aaaaaaaaaaaab", "Ġx", "'re"]:
        assert OWN.merge_long(w.encode()) == OWN.merge_block([w.encode()])[0]


def test_special_strings_as_text():
    plain = op12.RankBpe(op12.TOKENIZER, special_as_text=True)
    ids = np.frombuffer(plain.encode(["a<|endoftext|>"])[0], "<u4").tolist()
    assert 50256 not in ids and plain.decode(ids) == "a<|endoftext|>"


def test_a_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(op12, "CACHE_WORDS", 4)
    own = op12.RankBpe(op12.TOKENIZER)
    for text in ["one two three four five", "two six", "one two seven", ""] * 2:
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == LIBRARY.encode(text).ids


def test_rank_bpe_rows(spark):
    df = spark.createDataFrame([(1, None, "k"), (None, "", "k"), (2, "Hello there", "k"), (2, "Hello there", "k")],
                               "doc_id long, text string, ids string")
    out = op12.decode_ids(op12.encode_texts(df, op12.TOKENIZER), op12.TOKENIZER)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    assert rows(out.select("doc_id", "ids", "decoded")) == sorted(
        [(1, [], ""), (None, [], ""), (2, [15496, 612], "Hello there"), (2, [15496, 612], "Hello there")], key=str)
    assert op12.encode_texts(df.limit(0), op12.TOKENIZER).count() == 0
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert op12.decode_ids(nothing, op12.TOKENIZER).first().decoded == ""


# --- op13


def brute_clusters(vectors, k, rounds, seed):
    """(id, cluster, distance) with Python's integers only."""
    order = sorted(vectors, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    at = [v for _, v in order[:k]]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(at))

    for _ in range(rounds):
        own = [best(v)[1] for _, v in vectors]
        for c in range(len(at)):
            mine = [v for (_, v), o in zip(vectors, own) if o == c]
            if mine:
                at[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return sorted([(i, best(v)[1], best(v)[0]) for i, v in vectors], key=str), at


def clustered(spark, vectors, **kw):
    df = spark.createDataFrame(vectors, "id long, v array<bigint>").repartition(3)
    members, at = op13.cluster(df, **kw)
    return rows(members), at.tolist()


@pytest.mark.parametrize("spread, size", [(5, 1), (50, 1000), (3, 2 ** 26)])
def test_clusters_equal_brute_force(spark, spread, size):
    rng = random.Random(spread)
    vectors = [(i, [(rng.randrange(4) * spread + rng.randrange(-3, 4)) * size for _ in range(5)]) for i in range(200)]
    vectors += [(7, [0] * 5), (7, [0] * 5), (None, [-1] * 5)]
    want, at = brute_clusters(vectors, 6, 4, 3)
    assert clustered(spark, vectors, clusters=6, rounds=4, seed=3) == (want, at)


def test_ties_empty_clusters_and_few_vectors(spark):
    same = [(i, [4, 4]) for i in range(9)]
    want, at = brute_clusters(same, 3, 5, 3)
    assert clustered(spark, same, clusters=3, rounds=5, seed=3) == (want, at)
    assert {c for _, c, _ in want} == {0}
    two = [(1, [0, 0]), (2, [9, 9])]
    assert clustered(spark, two, clusters=8, rounds=2, seed=3) == brute_clusters(two, 8, 2, 3)
    assert clustered(spark, [], clusters=8, rounds=2, seed=3)[0] == []
    assert op13.with_inertia(*op13.cluster(spark.createDataFrame([], "id long, v array<bigint>"), 8, 2, 3)).count() == 0


def test_bounds_never_pass_the_distance_and_cut_far_centroids():
    rng = np.random.default_rng(1)
    centres = rng.integers(-10 ** 6, 10 ** 6, (8, 16))
    x = centres[rng.integers(0, 8, 2000)] + rng.integers(-500, 500, (2000, 16))
    pivots = x[:6]
    near, far, between = op13.distances(x, pivots), op13.distances(centres, pivots), op13.distances(pivots, pivots)
    low = op13.lower_bounds(near, far, between)
    true = np.stack([op13.exact_squares(x, c) for c in centres], axis=1)
    assert (low ** 2 <= true).all()
    own, best, measured = op13.nearest(x, near, centres, far, between)
    assert (best == true.min(axis=1)).all() and (own == true.argmin(axis=1)).all()
    assert measured < 2 * len(x)


def test_kept_vectors_and_extra_columns(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1, [1.0, -0.0001], "z"), (2, None, "z"), (3, [1.0], "z"), (4, [1.0, None], "z"),
                                (5, [nan, 1.0], "z"), (6, [1.0, -inf], "z"), (None, [0.0, 0.0], "z"), (7, [1e30, 0.0], "z")],
                               "vec_id long, embedding array<float>, v string")
    assert rows(op13.kept_vectors(df, "vec_id", "embedding", 2, 1024.0)) == sorted(
        [(1, [1024, -1]), (None, [0, 0]), (7, [2 ** 63 - 1, 0])], key=str)
