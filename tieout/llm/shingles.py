"""Weighted word shingles of many texts at once, as numpy arrays.

Words are runs of ASCII letters and digits and of bytes from 0x80, A-Z in lower
case. Words and shingles are 64-bit hashes. A text with fewer words than a
shingle has is one shingle. The weight of a shingle is how often it occurs.
"""

from __future__ import annotations

import numpy as np

WORDS_IN_SHINGLE = 5
BYTES_AT_ONCE = 1 << 21

U = np.uint64
GOLDEN = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _constants(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=U) + U(seed << 32)) * GOLDEN) | U(1)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Whether a byte belongs to a word, and its value; capitals count as small."""
    codes = np.arange(256)
    lower = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    in_word = (codes >= 128) | ((lower >= 97) & (lower <= 122)) | ((codes >= 48) & (codes <= 57))
    return in_word, _constants(256, 1)[lower]


def word_hashes(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in some bytes and where they start; words end at `breaks`."""
    in_word, value = _tables()
    inside = in_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at_break = breaks[breaks < len(data)]
    first[at_break] = inside[at_break]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, U), starts
    places = np.flatnonzero(inside)
    begin = np.searchsorted(places, starts)
    lengths = np.diff(np.append(begin, len(places)))
    in_order = np.arange(len(places)) - np.repeat(begin, lengths)
    powers = np.cumprod(np.full(lengths.max(), U(0xD6E8FEB86659FD93)), dtype=U)
    hashes = np.add.reduceat(value[data[places]] * powers[in_order], begin)
    return mix(hashes + lengths.astype(U)), starts


def pieces(data: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of about BYTES_AT_ONCE bytes that cut no word."""
    in_word, _ = _tables()
    out, at = [], 0
    while at < len(data):
        end = min(at + BYTES_AT_ONCE, len(data))
        while end < len(data) and in_word[data[end]]:
            end += 1
        out.append((at, end))
        at = end
    return out


def weighted_shingles(
    data: np.ndarray, offsets: np.ndarray, size: int = WORDS_IN_SHINGLE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight), sorted, of texts data[offsets[i]:offsets[i + 1]]."""
    data, offsets = data[: offsets[-1]], offsets.astype(np.int64)
    hashes, starts = [], []
    for begin, end in pieces(data):
        breaks = offsets[(offsets >= begin) & (offsets < end)] - begin
        h, s = word_hashes(data[begin:end], breaks)
        hashes.append(h)
        starts.append(s + begin)
    words = np.concatenate(hashes) if hashes else np.zeros(0, U)
    where = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    text = np.searchsorted(offsets, where, side="right") - 1
    n_words = np.bincount(text, minlength=len(offsets) - 1)
    ends = np.cumsum(n_words)
    factor = _constants(size, 2)
    # A short text is padded, so that the hash of its only shingle needs no case of its own.
    padded = np.concatenate([words, np.zeros(size - 1, U)])
    left = np.repeat(ends, n_words) - np.arange(len(words))
    total = np.zeros(len(words), U)
    for k in range(size):
        here = padded[k : k + len(words)] * factor[k]
        total += np.where(left > k, here, U(0))
    first = np.zeros(len(words), bool)
    first[(ends - n_words)[n_words > 0]] = True
    whole = (left >= size) | first
    shingle, text = mix(total[whole] + GOLDEN), text[whole]
    order = np.lexsort((shingle, text))
    shingle, text = shingle[order], text[order]
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(shingle)))
    return text[at], shingle[at], weight.astype(np.float64)


def batches(offsets: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of texts of about BYTES_AT_ONCE bytes together."""
    out, begin = [], 0
    for i in range(len(offsets) - 1):
        if offsets[i + 1] - offsets[begin] >= BYTES_AT_ONCE:
            out.append((begin, i + 1))
            begin = i + 1
    if begin < len(offsets) - 1:
        out.append((begin, len(offsets) - 1))
    return out


def probability_jaccard(
    a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray
) -> float:
    """The sum over common i of 1 / sum over j of max(a_j / a_i, b_j / b_i).

    max() picks a_j / a_i where a_j / b_j is at least a_i / b_i, so sorting by
    that ratio turns the inner sums into running ones.
    """
    common, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    only_a, only_b = wa.sum() - wa[ia].sum(), wb.sum() - wb[ib].sum()
    xa, xb = wa[ia], wb[ib]
    ratio = xa / xb
    order = np.argsort(ratio)
    xa, xb, ratio = xa[order], xb[order], ratio[order]
    at = np.searchsorted(ratio, ratio, side="left")
    a_above = only_a + np.append(np.cumsum(xa[::-1])[::-1], 0.0)[at]
    b_below = only_b + np.append(0.0, np.cumsum(xb))[at]
    return float((1.0 / (a_above / xa + b_below / xb)).sum())
