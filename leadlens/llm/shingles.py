"""Distinct word shingles of whole texts as 64-bit hashes, a batch of texts at a time.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased.  A
word's hash is a polynomial of its bytes, taken for all words of a batch from
one running sum; a shingle's hash mixes those of its words in order.  Two
different shingles of a pair of texts share a hash with a chance of some 1 in
10^19; digests of whole sets are 128-bit BLAKE2b.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken together up to so many bytes.
CHUNK_BYTES = 1 << 18

_rng = np.random.default_rng(20240607)
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = _TABLE[_LOWER]
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n - 1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n + 1, 1 << 18)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each word; no word reaches over a document's start."""
    black = ~_SPACE[raw]
    first, last = black.copy(), black.copy()
    first[1:] &= ~black[:-1]
    last[:-1] &= ~black[1:]
    own = doc_starts[doc_starts < len(raw)]
    first[own] = black[own]
    ends_at = own[own > 0] - 1
    last[ends_at] = black[ends_at]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_LETTER[raw] * powers(_BASE, len(raw)), out=total[1:])
    h = (total[end] - total[start]) * powers(_BACK, len(raw) + 1)[start]
    h += (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mixed(h), np.searchsorted(doc_starts, start, side="right") - 1


def shingle_sets(raw: np.ndarray, doc_starts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct hashes of all documents one after the other, number per document)."""
    docs = len(doc_starts)
    h, doc = word_hashes(raw, doc_starts)
    per_doc = np.bincount(doc, minlength=docs)
    n = max(0, len(h) - words + 1)
    s = np.zeros(n, dtype=np.uint64)
    for j in range(words):
        s = s * np.uint64(0xA0761D6478BD642F) + (h[j:j + n] ^ np.uint64(j))
    s = s ^ (s >> np.uint64(32))
    inside = doc[:n] == doc[words - 1:words - 1 + n]
    s, s_doc = s[inside], doc[:n][inside]
    short = np.flatnonzero((per_doc > 0) & (per_doc < words))
    if len(short):
        first = np.cumsum(per_doc) - per_doc
        extra = []
        for d in short:
            x = int(per_doc[d]) + 1
            for w in h[first[d]:first[d] + per_doc[d]].tolist():
                x = (x * 0xE7037ED1A0B428DB + w) & 0xFFFFFFFFFFFFFFFF
            extra.append(x)
        at = np.searchsorted(s_doc, short)
        s, s_doc = np.insert(s, at, np.array(extra, dtype=np.uint64)), np.insert(s_doc, at, short)
    count = np.bincount(s_doc, minlength=docs)
    end = np.cumsum(count)
    for a, b in zip((end - count).tolist(), end.tolist(), strict=True):
        s[a:b].sort()
    fresh = np.ones(len(s), dtype=bool)
    fresh[1:] = (s[1:] != s[:-1]) | (s_doc[1:] != s_doc[:-1])
    return s[fresh], np.bincount(s_doc[fresh], minlength=docs)


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, start of each row's text in them) of runs of rows; null texts are empty."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1)
        j = min(j, len(texts))
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j] - offsets[i]
        i = j


def set_digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
