"""Word and n-gram hashes of a batch of texts, in numpy."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) plain words of a text as UTF-8 bytes.

    ``bytes.lower`` and ``bytes.split`` are ASCII-only, which is the rule.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a one-to-one function)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; entry i starts at word i."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        h = mixed(h * _ODD + words[k:len(words) - n + 1 + k])
    return h


def slices(texts: list, chars: int = 1 << 20):
    """(start, stop) runs of a batch with about ``chars`` characters each, so
    that a batch's words are never all in memory at once."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= chars:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def shingle_sets(texts: list, width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles; a
    text with fewer words is one shingle, one without words has none."""
    split = [plain_words(t) for t in texts]
    flat = word_hashes([w for words in split for w in words])
    hashes = ngram_hashes(flat, width)
    out, at = [], 0
    for words in split:
        n = len(words)
        if n >= width:
            out.append(np.unique(hashes[at:at + n - width + 1]))
        elif n:
            out.append(ngram_hashes(flat[at:at + n], n))
        else:
            out.append(hashes[:0])
        at += n
    return out
