"""Every operator against brute force and on odd rows: nulls, empties, ties, repeats, clashing names, empty tables."""

import hashlib
import io
import struct

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronoleaf.llm import (common, op1_chat, op2_topk, op3_html, op4_substring, op5_exact, op6_toxicity, op7_binary,
                            op8_simhash, op9_bpe, op10_mixing, words)
from chronoleaf.session import scratch_dir
from tests.llm import brute

import public_tokenizers

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def docs(spark, rows, extra=""):
    return spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string" + extra)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- words


def test_word_hashes_are_those_of_the_words_alone():
    texts = [b"", b"one", b"x" * 200 + b" " + b"y" * 64, "é ü\t\nß".encode(), b"one two three four five six seven eight"]
    buf = b"\n".join(texts)
    start, end = words.spans(buf)
    found = [buf[a:b] for a, b in zip(start, end)]
    assert found == buf.split()
    h = words.word_hashes(buf, start, end)
    for w, x in zip(found, h):
        s, e = words.spans(w)
        assert words.word_hashes(w, s, e)[0] == x
    assert len(set(h.tolist())) == len(set(found))
    assert words.owners(np.array([len(t) for t in texts]), start).tolist() == [1, 2, 2, 3, 3, 3] + [4] * 8
    for n in (1, 2, 3, 5, 8):
        runs = words.run_hashes(h, n)
        assert len(runs) == len(h) - n + 1
        assert words.run_hashes(h[3:3 + n], n)[0] == runs[3]


# --- op1


def turns(spark, rows, extra=""):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string" + extra)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "odd\nrole", "<|im_end|>", "", None]),
                          st.one_of(st.none(), st.text(st.sampled_from("<|\\im_endstar>\n a$é"), max_size=30))),
                min_size=1, max_size=8))
def test_chat_reads_back_unchanged(spark, said):
    df = turns(spark, [(1, i, r, t) for i, (r, t) in enumerate(said)])
    row = op1_chat.read_back(op1_chat.format_chats(df)).collect()[0]
    assert [(t.role, t.text) for t in row.turns] == [(r or "", t or "") for r, t in said]
    assert row.loss_text == "".join(t or "" for r, t in said if r == "assistant")
    assert row.formatted == "".join(s.text for s in row.segments)
    assert row.formatted.count("<|im_start|>") == row.formatted.count("<|im_end|>\n") == len(said)


def test_chat_machine_ties_and_clashing_names(spark):
    rows = [(1, 0, "system", "s", "z"), (1, 1, "user", "u", "z"), (1, 2, "assistant", "a", "z"),
            (2, 0, "assistant", "a", "z"), (3, 0, "user", "u", "z"), (3, 1, "user", "v", "z"),
            (4, 5, "user", "b", "z"), (4, 5, "assistant", "a", "z"), (None, 1, "user", None, "z")]
    df = turns(spark, rows, ", formatted string")
    out = {r.conv_id: r for r in op1_chat.format_chats(df).collect()}
    assert {k: (r.n_turns, r.valid, r.complete, r.first_bad_turn) for k, r in out.items()} == {
        1: (3, True, True, None), 2: (1, False, True, 0), 3: (2, False, False, 1), 4: (2, False, False, 0),
        None: (1, True, False, None)}
    assert out[4].formatted.startswith("<|im_start|>assistant\na<|im_end|>\n")   # equal turns: by role, then text
    assert [(s.text, s.loss) for s in out[1].segments][3:9] == [
        ("<|im_start|>user\n", False), ("u", False), ("<|im_end|>\n", False),
        ("<|im_start|>assistant\n", False), ("a", True), ("<|im_end|>\n", False)]
    assert op1_chat.format_chats(df.where("false")).count() == 0


# --- op2


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def brute_topk(rows, k):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            q = [int(np.floor(1024 * float(np.float32(x)))) for x in v]
            kept[i] = min(kept.get(i, q), q)
    out = []
    for i, q in kept.items():
        if i % 10 == 0:
            s = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in kept.items() if j != i and len(c) == len(q))
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard,run,block", [(4096, 8, 1024), (37, 2, 5)])
def test_topk_equals_brute_force(spark, monkeypatch, shard, run, block):
    monkeypatch.setattr(op2_topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(op2_topk, "RUN_SHARDS", run)
    monkeypatch.setattr(op2_topk, "BLOCK_QUERIES", block)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=5).round(1)]) for i in range(300)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0, 0.0]) for i in range(300, 420)]          # a large group of ties
    rows += [(420, None), (430, [1.0, None, 0.0, 0.0, 0.0]), (440, [float("nan")] * 5), (450, [float("inf")] * 5),
             (460, [2.0, 1.0]), (461, [1.0, 1.0]), (470, []), (471, []), (None, [1.0] * 5),
             (10, [9.0, 9.0, 9.0, 9.0, 9.0]), (480, [3e5] * 3), (481, [2e5] * 3)]
    found = op2_topk.quantized(vectors(spark, rows), "vec_id", "embedding", 1024.0)
    assert got(op2_topk.top_k(spark, found.where("id % 10 = 0"), found, 4)) == brute_topk(rows, 4)


def test_topk_empty(spark):
    none = op2_topk.quantized(vectors(spark, []), "vec_id", "embedding", 1024.0)
    assert op2_topk.top_k(spark, none, none, 10).count() == 0


# --- op3


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">menu one</a></li><li><a href="/b">menu two</a></li></ul></nav><div class="ad">buy now buy now</div>
<article><h1>Head &amp; line</h1><p><b>bold<i>er</i>   words\n here<br><p>second a &lt; b&nbsp;c <a href="x">a link</a> goes on with words
<p>third block of the article<div class="comments"><p>first comment here</div></article><footer>&copy; host and more words</footer></body></html>"""


def test_html_text_and_odd_pages(spark):
    plain = "".join(f"<html><body><nav><a href=/{i}>go {i}</a></nav><article><h1>t{i}</h1><p>" + "word " * 30
                    + "</p></article><footer>small print here</footer></body></html>" for i in range(1))
    pages = [(i, f"u{i}", plain, "x") for i in range(20)] + [(100, "u", PAGE, "x"), (101, None, None, "x"), (102, "u", "", "x"),
             (103, "u", "no tags at all, just words", "x"), (104, "u", "<p>cut <a href='x", "x"), (None, "u", "<p>" * 50_000, "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    weights = op3_html.learn_weights(df)
    assert weights["word"] > 0 and weights["boilerplate word"] < 0 and weights["tag p"] < 0
    out = {r.page_id: r.text for r in op3_html.extract_text(df, weights).collect()}
    assert out[100] == "Head & line bolder words here second a < b c a link goes on with words third block of the article"
    assert out[0] == "t0 " + " ".join(["word"] * 30)
    assert (out[101], out[102], out[None]) == ("", "", "")
    assert out[103] == "no tags at all, just words" and out[104] == "cut"
    assert op3_html.learn_weights(df.where("false")) == op3_html.PRIOR
    assert op3_html.extract_text(df.where("false"), op3_html.PRIOR).count() == 0


def test_html_region_without_labels():
    page = "<div><a href=1>x</a><a href=2>y</a></div><div>" + "".join(f"<p>{'real text ' * 9}</p>" for _ in range(4)) + "</div><ul><li><a>z</a></ul>"
    assert op3_html.main_text(page, op3_html.PRIOR) == " ".join(["real text"] * 36)


LEARNED = op3_html.PRIOR | {"word": 4.0, "link": -4.0, "boilerplate word": -4.0, "tag p": -0.02, "tag h1": -0.02}   # as learned from the given pages


@pytest.mark.parametrize("weights", [op3_html.PRIOR, LEARNED])
@pytest.mark.parametrize("block", ["<div class=ad><p>{}</p></div>", "<form><p>{}</form>", "<aside>{}</aside>",
                                   "<section class='comments'><ul><li>{}</li></ul></section>", "<div id=cookie>{}</div>"])
def test_html_boilerplate_inside_an_article(weights, block):
    long, close, other = " ".join(["long"] * 100), " ".join(["close"] * 20), " ".join(["other"] * 30)
    menu = "<div><a href=1>x</a><a href=2>y</a></div>"
    for first, last in ((long, close), (close, long)):
        page = f"<body>{menu}<article><p>{first}</p>{block.format(other)}<p>{last}</p></article>{menu}</body>"
        assert op3_html.main_text(page, weights) == f"{first} {last}"


@pytest.mark.parametrize("weights", [op3_html.PRIOR, LEARNED])
@pytest.mark.parametrize("around", ["<article>{}</article>", "<div>{}</div>", "<article><h1>Why</h1><div>{}</div><p>So</p></article>"])
@pytest.mark.parametrize("edge,text", [
    ("<p>See <a href=x>the whole long report here</a></p>", "See the whole long report here"),
    ("<p><a href=x>the report</a></p>", "the report"), ("<p><a href=x>the report</a> and <a href=y>its many notes</a>",
    "the report and its many notes"), ("<ul><li>one</li><li>two</li></ul>", "one two"), ("<blockquote><b>so</b></blockquote>", "so")])
def test_html_links_and_lists_at_the_edge(weights, around, edge, text):
    words = " ".join(["word"] * 60)
    menu = "<div><ul><li><a href=1>x</a></li><li><a href=2>y</a></li></ul></div>"
    h, s = ("Why ", " So") if "Why" in around else ("", "")
    for body, want in ((f"<p>{words}</p>{edge}", f"{words} {text}"), (f"{edge}<p>{words}</p>", f"{text} {words}")):
        page = f"<html><body>{menu}{around.format(body)}{menu}</body></html>"
        assert op3_html.main_text(page, weights) == f"{h}{want}{s}"


@pytest.mark.parametrize("weights", [op3_html.PRIOR, LEARNED])
def test_html_classes_do_not_hide_the_page(weights):
    text, menu = " ".join(["word"] * 60), "<ul><li><a href=1>x</a></li><li><a href=2>y</a></li></ul>"
    for open_, close in (("<body class='no-sidebar'>", ""), ("<body class='sidebar'>", ""), ("<div id=page class='has-sidebar'>", "</div>"),
                         ("<article class='post share-enabled'>", "</article>"), ("<article class=widget>", "</article>"),
                         ("<main id=main role=main class='share'>", "</main>"), ("<div class='content with-comments'>", "</div>"),
                         ("<div class=widget>", "</div>"), ("<div class=banner><div class='share widget'>", "</div></div>"),
                         ("<article><div class=widget>", "</div></article>"), ("<div data-id=ad>", "</div>")):
        assert op3_html.main_text(f"{menu}{open_}<p>{text}</p>{close}{menu}", weights) == text, open_
    # they do hide what is not the page
    for other in ("<div class=ad>", "<div class='box ad-banner'>", "<div id=comments>", "<div class='share_2'>", "<div role='navigation'>"):
        assert op3_html.main_text(f"<body><div><p>{text}</p>{other}<p>{text[:100]}</p></div><p>{text}</p></div>", weights) == f"{text} {text}", other
        assert op3_html.main_text(f"{other}<p>{text}</p></div><article><p>one two three</p></article>", weights) == "one two three"
        assert op3_html.main_text(f"<article><p>one two three</p>{other}{text[:40]}</div></article>", weights) == "one two three"


@pytest.mark.parametrize("weights", [op3_html.PRIOR, LEARNED])
def test_html_page_inside_a_form_and_self_closed_svg(weights):
    text = " ".join(["some words of the article"] * 12)
    login = "<form><label>name</label><input><button>log in now</button></form>"
    for page, want in [(f"<body><form action=/><div><p>{text}</p></div></form></body>", text),
                       (f"<body><form><fieldset><article><p>{text}</p></article></fieldset></form></body>", text),
                       (f"<body>{login}<article><p>{text}</p>{login}</article>{login}</body>", text),
                       (f"<body><p>{text} <svg/> two <svg><text>drawn</text></svg> three</p></body>", f"{text} two three"),
                       (f"<body><svg class=x><p>drawn</p><p>{text}</p></body>", f"drawn {text}"),
                       (f"<noscript>turn it on</noscript><p>{text}</p><template><p>no</p></template>", text)]:
        assert op3_html.main_text(page, weights) == want, page


@pytest.mark.parametrize("odd", ["<svg>", "<noscript>", "<template>", "</div>", "<div></section>", "<div>", "<svg></svg>", "<svg/>",
                                 "<a>", "<form>"])
def test_html_takes_linear_time_on_odd_tags(odd):
    import time
    page = "<p>" + "some words here " * 100 + "</p>" + odd * 100_000
    start = time.process_time()
    assert "some words here" in op3_html.main_text(page, LEARNED)
    assert time.process_time() - start < 6            # linear: under 2 s each


def test_html_repeated_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>one two three four</p>")] * 3, "page_id long, url string, html string")
    assert [r.text for r in op3_html.extract_text(df, op3_html.learn_weights(df)).collect()] == ["one two three four"] * 3


def test_html_open_links_end_with_their_block():
    text = " ".join(["word"] * 60)
    for start in ("<p><a name=top></p>", "<a name=top>", "<p><a href=x>go<br></p>", "<a href=x>go"):
        page = f"<body><article><p>{text}</p>{start}<p>{text}</p><p>{text} <a href=y>z</a></p></article></body>"
        kinds = [k for k, content, _, _ in op3_html.pieces(page) if "word" in content]
        assert kinds == ["word"] * 3, start
        assert op3_html.main_text(page, LEARNED) == f"{text}{' go' * ('go' in start)} {text} {text} z"
    assert [k for k, _, n, _ in op3_html.pieces("<a href=x><h2>title</h2><p>teaser</p></a>") if n] == ["link", "link"]


# --- op4


@pytest.mark.parametrize("seed,window,chunk", [(1, 20, 8 << 20), (2, 20, 300), (3, 5, 2000), (4, 17, 1)])
def test_substring_equals_brute_force(spark, monkeypatch, seed, window, chunk):
    monkeypatch.setattr(op4_substring, "CHUNK_BYTES", chunk)
    rows = brute.noisy_documents(seed)
    rows += [rows[3], rows[20], rows[20]]                                      # repeated rows
    out = op4_substring.drop_repeats(docs(spark, rows).repartition(3), window)
    mine = got(out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)))
    assert mine == sorted(op4_substring.brute_force(rows, window), key=str)
    assert sum(r[2] for r in mine) > 100


def test_substring_survives_clashing_hashes(spark, monkeypatch):
    rows = brute.noisy_documents(5, 12)
    weak = lambda buf, start, end: (end - start).astype(np.uint64)             # noqa: E731  words of one length clash
    monkeypatch.setattr(op4_substring.W, "word_hashes", weak)
    split = list(op4_substring._split([d for d, _ in rows], [op4_substring._normal(t) for _, t in rows], 1, 5))
    gone = {}
    for d, r in [(d, r) for _, f, d, r in split if f] + list(op4_substring._repeats([r for _, f, _, r in split if not f], 5)):
        s, n = np.frombuffer(r, "<u4").reshape(2, -1)
        gone.setdefault(d, set()).update(w for a, b in zip(s.tolist(), n.tolist()) for w in range(a, a + b + 4))
    want = {d: k for d, _, k, _ in op4_substring.brute_force(rows, 5) if k}
    assert {d: len(x) for d, x in gone.items()} == want


def test_substring_null_ids_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(25))
    out = got(op4_substring.drop_repeats(docs(spark, [(None, text, 1), (5, text, 1), (6, None, 1)], ", ranges int")))
    assert op4_substring.drop_repeats(docs(spark, [(1, text), (2, text + " x"), (2, "y " + text + " z " + text)])).count() == 3
    assert out == sorted([(None, text, 25, 0), (5, "", 25, 25), (6, "", 0, 0)], key=str)
    assert op4_substring.drop_repeats(docs(spark, [])).count() == 0


def test_substring_splits_groups_of_common_phrases(spark, monkeypatch):
    rng = np.random.default_rng(3)
    word = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 10**6, n))      # noqa: E731
    licence = " ".join(f"l{i}" for i in range(30))
    rows = [(i, f"{word(30)} all rights reserved here now {word(30)} {licence if i % 2 else word(9)} {word(25)}") for i in range(600)]
    monkeypatch.setattr(op4_substring, "BUCKET_BYTES", 40_000)                 # 138 stretches
    frequent = op4_substring.frequent_runs(docs(spark, rows))
    assert len(frequent) == 2 + 27                                             # of the phrase, of the licence
    held = []
    for b, found, _, p in op4_substring._split([d for d, _ in rows], [op4_substring._normal(t) for _, t in rows], 997, 20, frequent):
        if not found:
            raw = op4_substring.zstandard.ZstdDecompressor().decompress(p)
            held.append(struct.unpack_from("<I", raw)[0])
    assert max(held) < 138 and sum(held) > 5000
    out = got(op4_substring.drop_repeats(docs(spark, rows).repartition(3)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256)))
    assert out == sorted(op4_substring.brute_force(rows), key=str)
    assert sum(r[2] for r in out) == 299 * 30


def test_substring_rows_that_share_an_id(spark, monkeypatch):
    rows = brute.noisy_documents(7)
    null = int(op4_substring._NULL_ID)
    rows = [(null if i % 3 == 0 else d // 4 if i % 3 == 1 else d, t) for i, (d, t) in enumerate(rows)] + rows[:2]
    for chunk in (8 << 20, 300):                                               # repeats found before and after the shuffle
        monkeypatch.setattr(op4_substring, "CHUNK_BYTES", chunk)
        out = op4_substring.drop_repeats(docs(spark, [(None if d == null else d, t) for d, t in rows]).repartition(3), 5)
        mine = got(out.select(F.coalesce("doc_id", F.lit(null)), "n_words", "n_removed", F.sha2("kept", 256)))
        assert mine == sorted(op4_substring.brute_force(rows, 5), key=str)
    assert sum(r[2] for r in mine) > 100


# --- op5


def brute_groups(rows):
    import re
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (d, _), n in zip(rows, norm):
        own = [e for (e, _), m in zip(rows, norm) if m == n]
        out.append((d, min((e for e in own if e is not None), default=None), len(own)))
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [op5_exact.sha256, lambda t: F.substring(F.sha2(t, 256), 1, 1)])
def test_exact_dedup_equals_brute_force_and_checks_bytes(spark, digest):
    rows = [*brute.noisy_documents(6, 40), (None, "lone"), (None, "x  y"), (3, "x y"), (2, "x\ty"), (2, "x y"), (None, None), (77, ""), (78, " ")]
    df = docs(spark, [(*r, 1) for r in rows], ", kept int").repartition(3)
    out = op5_exact.exact_dedup(df, digest=digest).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in out), key=str) == brute_groups(rows)
    import re
    stays = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in out if r.kept]
    assert len(stays) == len(set(stays)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in out if r.kept)


def test_exact_dedup_empty_and_many_batches(spark):
    assert op5_exact.exact_dedup(docs(spark, [])).count() == 0
    df = docs(spark, [(i, f"t{i % 7}") for i in range(70)]).repartition(9)
    out = op5_exact.exact_dedup(df, bytes_per_trigger=1).collect()             # a micro-batch for each file
    assert {(r.keep_id, r.group_size) for r in out} == {(i, 10) for i in range(7)}


def _repeated_places(spark, tmp_path):
    path = str(tmp_path / "docs")
    docs(spark, [(1, "a  b"), (2, "a b"), (3, "c"), (4, "d")]).coalesce(1).write.parquet(path)
    scan = spark.read.parquet(path)
    return [scan.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).drop("n"),
            spark.read.parquet(path, path), scan.union(scan)]


def test_exact_dedup_keeps_one_row_of_repeated_places(spark, tmp_path):
    for df in _repeated_places(spark, tmp_path):
        out = op5_exact.exact_dedup(df).collect()
        assert len(out) == 8 and sorted(r.doc_id for r in out if r.kept) == [1, 3, 4]
        assert {(r.keep_id, r.group_size) for r in out} == {(1, 4), (3, 2), (4, 2)}


def test_placed_writes_only_what_is_no_plain_scan(spark, tmp_path):
    path = str(tmp_path / "plain")
    docs(spark, [(1, "a"), (2, "b")]).write.parquet(path)
    scan = spark.read.parquet(path).select("text", "doc_id").where("doc_id > 0")
    assert all("plain" in r.at.file for r in common.placed(scan, "at", "x").collect())
    assert all("plain" not in r.at.file for r in common.placed(scan.limit(5), "at", "x").collect())


# --- op6


def _plain_ftrl(rows, m, epochs):
    """FTRL-proximal by its definition, coordinate by coordinate over dicts."""
    import math
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= m.l1:
            return 0.0
        return -(z[i] - math.copysign(m.l1, z[i])) / ((m.beta + math.sqrt(n[i])) / m.alpha + m.l2)

    for _ in range(epochs):
        for y, text in rows:
            slots = [int(i) for i in op6_toxicity.features(text)]
            w = {i: weight(i) for i in slots}
            g = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w.values()))))) - y
            for i in slots:
                old = n.get(i, 0.0)
                n[i] = old + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(old)) / m.alpha * w[i]
    return {i: w for i in z if (w := weight(i))}


@pytest.mark.parametrize("model", [op6_toxicity.Ftrl(), op6_toxicity.Ftrl(0.1, 0.5, 0.3, 0.0), op6_toxicity.Ftrl(1.0, 1.0, 0.0, 2.0)])
def test_toxicity_learner_equals_a_plain_version(model):
    rows = [(i % 3 == 0, " ".join(["fool", "fine", "day", "stupid", "tree", "rot"][(i * k) % 6] for k in range(1, 2 + i % 7)))
            for i in range(90)] + [(1, ""), (0, None), (1, "Émile fool " * 50)]
    got, want = op6_toxicity.train(rows, model, 3), _plain_ftrl(rows, model, 3)
    assert set(np.flatnonzero(got)) == set(want) and len(want) >= 5
    assert all(abs(got[i] - w) < 1e-9 for i, w in want.items())


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    scored = op6_toxicity.op6_toxicity(spark, sf).join(common.table(spark, sf, "labels"), "doc_id")
    rows = scored.where("held_out").select("score", "predicted", "toxic").collect()
    hit = sum(r.predicted == r.toxic for r in rows) / len(rows)
    bad = [r.score for r in rows if r.toxic]
    good = [r.score for r in rows if not r.toxic]
    auc = np.mean([(b > g) + (b == g) / 2 for b in bad for g in good])
    assert hit > 0.97 and auc > 0.97
    assert op6_toxicity.op6_toxicity(spark, sf).count() == common.table(spark, sf, "documents").count()


def test_toxicity_odd_rows(spark):
    rows = [(i, "you are a fool" if i % 2 else "a fine day", 9.0) for i in range(40)] + [(None, None, 9.0), (90, "", 9.0), (90, "", 9.0)]
    df = docs(spark, rows, ", score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, 0)], "doc_id long, toxic int")
    w = op6_toxicity.fit(df, labels)
    out = op6_toxicity.score_texts(df, w).collect()
    assert len(out) == 43 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert {r.predicted for r in out if r.text == "you are a fool"} == {1}
    assert {r.predicted for r in out if r.text == "a fine day"} == {0}
    assert np.count_nonzero(w) < 50
    for none in (labels.where("false"), labels.where("toxic = 0")):
        assert not op6_toxicity.fit(df, none).any()
    assert not op6_toxicity.fit(df.where("false"), labels).any()
    assert op6_toxicity.score_texts(df.where("false"), w).count() == 0


def test_toxicity_batch_scores_equal_single_ones():
    texts = ["", "a b a b", "The cat, the CAT sat", "é ü a b"]
    slots, owner = op6_toxicity._slots([t.encode().lower() for t in texts])
    for i, t in enumerate(texts):
        assert set(slots[owner == i].tolist()) | {0} == set(op6_toxicity.features(t).tolist())


# --- op7


def test_token_files_equal_the_library(spark):
    rows = brute.noisy_documents(8, 40)
    files = op7_binary.write_token_files(docs(spark, [(*r, 1) for r in rows], ", ids int"), scratch_dir(spark, "t"), WORD_BPE)
    out = op7_binary.read_token_files(files).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long"), F.crc32("ids"))
    assert got(out) == sorted(brute.tokens7(rows), key=str)


def test_word_cache_equals_whole_texts():
    enc = op7_binary.Encoder(WORD_BPE)
    texts = [t or "" for _, t in brute.noisy_documents(9, 80)] + [
        "it's 1234 <|endoftext|> é ́x İstanbul ǅ y\x1cz ﬁ 中文字 ͅ", "''s 'S d'd x'LL", "a\u0000b"]
    assert enc.by_word
    for _ in range(2):                                                        # the second time from the cache
        assert enc.encode(texts) == enc._ids(texts)


def test_token_file_random_access_and_damage(tmp_path):
    out = io.BytesIO()
    w = op7_binary.TokenFileWriter(out, 2)
    own = [(5, b""), (None, b"\1\0"), (2**60, np.arange(1000, dtype="<u2").tobytes()), (6, b"\2\0\3\0")]
    for d, ids in own:
        w.add(d, ids)
    w.close()
    data = out.getvalue()
    f = op7_binary.TokenFile(pa.BufferReader(data))
    assert f.doc_ids == [5, None, 2**60, 6] and f.lengths.tolist() == [0, 1, 1000, 2]
    assert f.document(2).tolist() == list(range(1000)) and f.document(3).tolist() == [2, 3]
    assert [d for d, _ in f.documents(1)] == f.doc_ids
    bad = bytearray(data)
    bad[int(f.offset[2]) + 40] ^= 1
    g = op7_binary.TokenFile(pa.BufferReader(bytes(bad)))
    assert g.document(3).tolist() == [2, 3]                                   # other frames are untouched
    with pytest.raises(Exception):
        g.document(2)
    import zstandard
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain == b"".join(ids for _, ids in own)
    assert struct.unpack("<I", data[-4:])[0] == op7_binary.SEEKABLE


def test_token_files_null_ids_and_empty(spark):
    files = op7_binary.write_token_files(docs(spark, [(None, "a"), (1, None), (1, "b c")]), scratch_dir(spark, "t"), WORD_BPE)
    out = op7_binary.read_token_files(files).orderBy("start").collect()
    assert [r.doc_id for r in out] == [None, 1, 1] and sorted(len(r.ids) // 4 for r in out) == [1, 2, 3]
    files = op7_binary.write_token_files(docs(spark, []), scratch_dir(spark, "t"), WORD_BPE)
    assert op7_binary.read_token_files(files).count() == 0


# --- op8


@pytest.mark.parametrize("seed", [1, 2])
def test_simhash_equals_brute_force(spark, seed):
    rows = brute.noisy_documents(seed, 80)
    out = op8_simhash.near_duplicates(docs(spark, [(*r, 1) for r in rows], ", fp int").repartition(3))
    mine = got(out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id"))
    assert mine == sorted(brute.components8(rows), key=str)


def chain(n, rng):
    """Fingerprints in chains of 1- and 2-bit steps, and unrelated ones."""
    out = [int(x) for x in rng.integers(0, 2**63, n // 4)]
    while len(out) < n:
        f = out[rng.integers(len(out))]
        for b in rng.integers(0, 64, rng.integers(1, 4)):
            f ^= 1 << int(b)
        out.append(f)
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("split", [8192, 3])
def test_simhash_links_lose_no_component(spark, monkeypatch, split):
    monkeypatch.setattr(op8_simhash, "SPLIT_ROWS", split)
    fps = chain(600, np.random.default_rng(3))
    n = len(fps)
    a, b = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2, 1))
    want = op8_simhash._forest(n, a, b)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(4)
    roots = {r.node: r.root for r in op8_simhash.components(op8_simhash.links(df)).collect()}
    mine = [roots.get(int(x), int(x)) for x in fps.view(np.int64)]
    where = {}
    assert [where.setdefault(m, i) for i, m in enumerate(mine)] == [int(w) for w in want]
    assert len(set(want.tolist())) < n


def test_simhash_pairs_by_pivots_are_all_pairs():
    fps = np.unique(np.concatenate([chain(400, np.random.default_rng(4)), np.array([1 << i for i in range(64)], np.uint64)]))
    a, b = op8_simhash._close_pairs(fps, 2)
    x, y = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2, 1))
    assert {frozenset(p) for p in zip(a.tolist(), b.tolist())} == {frozenset(p) for p in zip(x.tolist(), y.tolist())}


def test_simhash_null_ids_and_empty(spark):
    out = got(op8_simhash.near_duplicates(docs(spark, [(None, ""), (4, None), (3, "\n"), (None, "a b c d")])))
    assert {(r[0], r[2]) for r in out} == {(None, 3), (4, 3), (3, 3), (None, None)}
    assert op8_simhash.near_duplicates(docs(spark, [])).count() == 0


# --- op9


def test_bpe_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op9_bpe, "PART_CHARS", 40)
    rows = brute.noisy_documents(10, 40) + [(1, "x" * 500), (2, " " * 500 + "y"), (3, "<|endoftext|> 'll 　　z 12"), (3, "<|endoftext|>")]
    out = op9_bpe.round_trip(docs(spark, [(*r, 1) for r in rows], ", ids int"))
    assert got(out) == sorted(brute.codec9(rows), key=str)
    assert op9_bpe.round_trip(docs(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("ab'sl 1.\n\t é中😀́"), max_size=200))
def test_bpe_parts_are_safe(text):
    own = op9_bpe.bpe(op9_bpe.RANKS, op9_bpe.PATTERN)
    whole = own.encoding.encode_ordinary(text)
    cut = [m.start() for m in op9_bpe._SAFE.finditer(text)]
    parts = [text[a:b] for a, b in zip([0, *cut], [*cut, len(text)])]
    assert [i for p in parts for i in own.encoding.encode_ordinary(p)] == whole
    assert own.decode(np.array(whole, "<u4")) == text.encode()


def test_bpe_decodes_ids_that_end_inside_a_character():
    own = op9_bpe.bpe(op9_bpe.RANKS, op9_bpe.PATTERN)
    ids = own.encode("😀" * 3 + "\U0001F9FF")
    assert own.decode(ids[:-1]) == "".join(["😀"] * 3 + ["\U0001F9FF"]).encode()[:len(own.decode(ids[:-1]))]


# --- op10


def test_mixing_rates_counts_and_order(spark):
    rows = [(i, f"t{i}", "big" if i % 3 == 0 else ("rare" if i % 100 == 1 else f"s{i % 5}"), 7) for i in range(6000)]
    df = spark.createDataFrame([*rows, (None, "n", None, 7)], "doc_id long, text string, source string, copy int")
    shares = {"big": 0.1, "rare": 0.3, "absent": 0.5}
    mean = op10_mixing.rates(df, shares, 0.2)
    assert mean["rare"] > op10_mixing.PART and "absent" not in mean             # more than one draw a document
    out = op10_mixing.mix_sources(df, shares, 0.2).collect()
    n = {s: sum(r.source == s for r in out) for s in ("big", "rare")}
    assert abs(n["big"] / len(out) - 1 / 6) < 0.02 and abs(n["rare"] / len(out) - 1 / 2) < 0.04
    assert abs(len(out) - 6001) < 400
    keys = [r.shuffle_key for r in out]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    assert {(r.doc_id, r.copy) for r in out} == {(d, c) for d in {r.doc_id for r in out}
                                                 for c in range(sum(x.doc_id == d for x in out))} if len(out) < 100 else True
    again = op10_mixing.mix_sources(df.repartition(7), shares, 0.2).collect()
    assert [(r.doc_id, r.copy) for r in again] == [(r.doc_id, r.copy) for r in out]
    assert op10_mixing.mix_sources(df.where("false"), shares, 0.2).count() == 0


def test_mixing_counts_are_poisson(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"))
    n = np.array([r[0] for r in df.select(op10_mixing.repetitions(2.5, "s", F.col("doc_id"))).collect()])
    assert abs(n.mean() - 2.5) < 0.05 and abs(n.var() - 2.5) < 0.1
    cdf = op10_mixing.poisson_cdf(2.5)
    for k in range(6):
        assert abs((n <= k).mean() - cdf[k]) < 0.015
