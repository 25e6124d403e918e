"""Word shingles of whole texts as 64-bit hashes, for a batch of UTF-8 texts at a time with array operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEPS = [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3]
#: Bytes of text that one pass of array operations takes, longer single texts excepted.
CHUNK = 4 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every bit depends on all."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word after lower-casing A-Z, and the index of its text."""
    n = len(data)
    if not n:
        return np.zeros(0, U), np.zeros(0, np.int64)
    low = np.where((data >= 65) & (data <= 90), data + 32, data)
    inside = ~((low == 32) | ((low >= 9) & (low <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[offsets[offsets <= n]] = True
    starts = np.flatnonzero(inside & (np.concatenate([[True], ~inside[:-1]]) | edge[:n]))
    ends = np.flatnonzero(inside & (np.concatenate([~inside[1:], [True]]) | edge[1:])) + 1
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.concatenate([[U(1)], np.full(n - 1, U(_BASE))]))
        sums = np.concatenate([[U(0)], np.add.accumulate((low.astype(U) + U(1)) * powers)])
        back = np.multiply.accumulate(np.concatenate([[U(1)], np.full(n - 1, U(_INVERSE))]))
        hashes = mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(U) * U(_STEPS[0]))
    return hashes, np.searchsorted(offsets, starts, side="right") - 1


def sets_of(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct shingles of all texts one after the other, and where each text's begin (one more at the end).

    A text of fewer words than ``size`` has its whole sequence as its one shingle; one without words has none.
    """
    words, doc = _words(data, offsets)
    texts = len(offsets) - 1
    per = np.bincount(doc, minlength=texts)
    first = np.concatenate([[0], np.cumsum(per)])
    with np.errstate(over="ignore"):
        count = max(0, len(words) - size + 1)
        total = np.zeros(count, U)
        for k in range(size):
            total += words[k : k + count] * U(_STEPS[k % len(_STEPS)] + 2 * k)
        whole = doc[:count] == doc[size - 1 :] if count else np.zeros(0, bool)
        grams, owner = mixed(total[whole]), doc[:count][whole]
        few = np.flatnonzero((per > 0) & (per < size))
        short = np.zeros(len(few), U)
        for i, d in enumerate(few):
            for k, w in enumerate(words[first[d] : first[d + 1]]):
                short[i] += w * U(_STEPS[k % len(_STEPS)] + 2 * k)
            short[i] += U(per[d])
        grams, owner = np.concatenate([grams, mixed(short ^ U(_STEPS[1]))]), np.concatenate([owner, few])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts))])


def chunks(texts: pa.Array, size: int, limit: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, shingles, begins) for runs of texts of about ``limit`` bytes; nulls are empty."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(len(texts), max(end, at + 1))
        yield at, *sets_of(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at], size)
        at = end
