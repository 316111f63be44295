"""Vectorised words and hashes of a batch of texts (NumPy inside a task).

A batch is one ``bytes`` buffer; words are maximal runs of word bytes.  A hash
of a word is 64 bits, built eight bytes at a time; hashes of longer word runs
are built by doubling.  Callers that need certainty compare the bytes too.
"""

from __future__ import annotations

import numpy as np
import xxhash

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_S29, _S32 = np.uint64(29), np.uint64(32)
_LONG = 64  # longer words are hashed one by one

#: byte -> part of a word; the separators are \x20 and \x09-\x0D
SPACE_SEPARATED = np.ones(256, bool)
SPACE_SEPARATED[[0x20, *range(0x09, 0x0E)]] = False

#: byte -> part of a word; ASCII punctuation separates too, bytes of longer code points do not
ALNUM_SEPARATED = np.array([chr(i).isalnum() or i >= 128 for i in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S32)) * _A
    x = (x ^ (x >> _S29)) * _B
    return x ^ (x >> _S32)


def spans(buf: bytes, is_word: np.ndarray = SPACE_SEPARATED) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of ``buf``."""
    flags = np.zeros(len(buf) + 2, np.int8)
    flags[1:-1] = is_word[np.frombuffer(buf, np.uint8)]
    step = np.diff(flags)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def lanes(buf: bytes) -> np.ndarray:
    """The eight bytes from every offset of ``buf`` as one number (an overlapping view)."""
    padded = np.frombuffer(buf + bytes(16), np.uint8)
    return np.ndarray((len(buf) + 8,), "<u8", padded, 0, (1,))


_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


def word_hashes(buf: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    view, n = lanes(buf), end - start
    out = n.astype(np.uint64) * _B
    short = np.flatnonzero(n <= _LONG)
    at = 0
    while len(short):
        part = view[start[short] + at] & _KEEP[np.minimum(n[short] - at, 8)]
        out[short] = mix(out[short] ^ (part * _A))
        at += 8
        short = short[n[short] > at]
    for i in np.flatnonzero(n > _LONG):
        out[i] = xxhash.xxh64_intdigest(buf[start[i]:end[i]], 7)
    return out


def prefix_hashes(view: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """Hash of the first ``n`` (at most 8) bytes from each offset (view: lanes())."""
    return mix((view[start] & _KEEP[n]) ^ (np.full(1, n, np.uint64) * _B))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring runs from the hashes of each."""
    return mix(a * _A + np.uint64(1) ^ mix(b + _B))


def run_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` items from each position (positions too near the end left out)."""
    if len(h) < length:
        return h[:0]
    out, width, have = None, 1, h
    total = 0
    while True:  # the binary digits of length, smallest first
        if length & width:
            keep = len(h) - total - width + 1
            out = have[:keep] if out is None else pair(out[:keep], have[total:total + keep])
            total += width
        if total == length:
            return out
        have = pair(have[:-width], have[width:])
        width *= 2


def owners(lengths: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For texts joined by one separator byte: the text that holds each offset."""
    ends = np.cumsum(lengths + 1)
    return np.searchsorted(ends, start, "right")


def same_bytes(view: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether ``n`` bytes from offsets ``a`` equal those from offsets ``b`` (view: lanes())."""
    same = np.ones(len(a), bool)
    left, at = np.arange(len(a)), 0
    while len(left):
        keep = _KEEP[np.minimum(n[left] - at, 8)]
        equal = (view[a[left] + at] & keep) == (view[b[left] + at] & keep)
        same[left[~equal]] = False
        at += 8
        left = left[equal]
        left = left[n[left] > at]
    return same
