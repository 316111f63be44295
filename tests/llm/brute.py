"""Brute-force versions of operators that SQL cannot express; plain Python over small inputs."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import tiktoken
import xxhash

from chronoleaf.llm import op9_bpe

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def tokens7(rows):
    """op7: the library over whole texts, one by one."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: r[0]):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def simhash(text) -> int:
    ws = WORD.findall((text or "").encode().lower())
    if not ws:
        return 0
    grams = [b" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components8(rows):
    """op8: every pair of fingerprints compared."""
    fps = [(d, simhash(t)) for d, t in rows]
    distinct = np.array(sorted({f for _, f in fps}), np.uint64)
    root = {int(f): int(f) for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for f in distinct:
        for g in distinct[np.bitwise_count(distinct ^ f) <= 2]:
            a, b = find(int(f)), find(int(g))
            root[max(a, b)] = min(a, b)
    least = {}
    for d, f in fps:
        r = find(f)
        least[r] = min(least.get(r, d), d)
    return [(d, f"{f:016x}", least[find(f)]) for d, f in fps]


def codec9(rows):
    """op9: every match of the pattern encoded by itself."""
    import base64
    with open(op9_bpe.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    import regex
    pattern, out = regex.compile(public_tokenizers.PATTERN), []
    for d, t in rows:
        ids = [i for m in pattern.finditer(t or "") for i in enc.encode_ordinary(m[0])]
        out.append((d, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode())))
    return out


def noisy_documents(seed: int, n: int = 60):
    """(doc_id, text) rows with shared passages, copies, near copies, nulls, empties and odd white space."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)] + ["é", "straße,", "don't", "a" * 90, " x", "😀", "l'ÉTÉ.", "ΑΣ"]
    passage = [rng.choice(vocab) for _ in range(45)]
    rows = []
    for i in range(n):
        ws = [rng.choice(vocab) for _ in range(rng.randrange(0, 80))]
        if rng.random() < 0.4:
            a = rng.randrange(0, 20)
            ws[len(ws) // 2:len(ws) // 2] = passage[a:a + rng.randrange(15, 45)]
        if rows and rng.random() < 0.3:
            ws = (rng.choice(rows)[1] or "").split()
            if ws and rng.random() < 0.5:
                ws[rng.randrange(len(ws))] = "changed"
        text = "".join(w + rng.choice([" ", " ", "\n", "\t ", "  "]) for w in ws)
        rows.append((i * 7 - 50, rng.choice([None, ""]) if rng.random() < 0.1 else text))
    rows.append((9000, "same " * 200))
    rows.append((9001, "same " * 70))
    rng.shuffle(rows)
    return rows
