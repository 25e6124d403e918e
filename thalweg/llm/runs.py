"""Periodic runs of words, by Lyndon roots.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends with that period; those
of at least ``max(least_words, least_periods * q)`` words are found. By the runs theorem, each run holds a longest Lyndon
word that begins in its first period and has its length, under an order of words or under the reverse one. Both orders
are scanned from right to left with a stack of suffixes, each smaller than those above it; what remains on the stack
ends the longest Lyndon word of a position. Suffixes that begin alike, and the stretches over which a root repeats, are
measured by a binary search over rolling hashes, and every stretch so found is compared word by word before it counts; a
collision of hashes costs time, never a result. There is no suffix array.

The work of a text is linear but for those searches; a text is handled as a whole, by itself, within the partitions of
the input. Nothing is shuffled, so copies, hot sources and frequent words make no hot task.

Nulls: a null text has no words and no run; its collapsed text is empty. Null or repeated keys are kept, each row is a
document. An empty table gives an empty result. Columns of the names added are replaced; others may have any names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import need
from .shingles import mixed

U = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
#: Words that are compared one by one before hashes are.
_FIRST = 8


@dataclass(frozen=True)
class Runs:
    least_words: int = 6
    least_periods: int = 4


class Stretches:
    """How far equal words reach, at a distance, in one sequence of word numbers."""

    def __init__(self, words: list[int]):
        self.words = words
        self.array = np.array(words, np.int64)
        #: By distance, the range last found over which words equal those later, which isn't wider to the right.
        self.known: dict[int, tuple[int, int]] = {}
        self._sums: list[int] | None = None

    def _hashes(self) -> None:
        with np.errstate(over="ignore"):
            powers = np.multiply.accumulate(np.concatenate([[U(1)], np.full(len(self.words), U(_BASE))]))
            values = mixed(self.array.astype(U) + U(1)) * powers[:-1]
            self._sums = [0, *np.add.accumulate(values).tolist()]
            self._powers = powers.tolist()

    def _alike(self, i: int, d: int, n: int) -> bool:
        s = self._sums
        return ((s[i + n] - s[i]) * self._powers[d] - s[i + d + n] + s[i + d]) & _MASK == 0

    def _compared(self, i: int, d: int, n: int, back: bool) -> int:
        """Of ``n`` words from ``i`` on (or up to it, ``back``) how many equal those ``d`` later, before the first that doesn't."""
        lo, hi = (i - n, i) if back else (i, i + n)
        unlike = np.flatnonzero(self.array[lo:hi] != self.array[lo + d : hi + d])
        return n if not len(unlike) else int(n - 1 - unlike[-1] if back else unlike[0])

    def _reach(self, i: int, d: int, most: int, back: bool) -> int:
        """Equal words from ``i`` on (or before it), at most ``most``: a gallop and a search over hashes, then a comparison."""
        if self._sums is None:
            self._hashes()
        start = (lambda n: i - n) if back else (lambda n: i)
        low, high = 0, 1
        while high < most and self._alike(start(high), d, high):
            low, high = high, 2 * high
        high = min(high, most) + 1  # the first length that isn't alike, or one more than there is
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if self._alike(start(mid), d, mid) else (low, mid)
        return self._compared(i, d, low, back)

    def around(self, i: int, d: int) -> tuple[int, int]:
        """The widest range around ``i`` whose words equal those ``d`` later; (i, i) if that at ``i`` doesn't."""
        ahead = i + self.ahead(i, d)
        if ahead == i:
            return i, i
        lo, hi = self.known.get(d, (0, -1))
        lo = lo if hi == ahead and lo < i else i  # the words between are known to be equal
        lo -= self._reach(lo, d, lo, True) if lo else 0
        self.known[d] = (lo, ahead)
        return lo, ahead

    def ahead(self, i: int, d: int) -> int:
        """How many words from ``i`` on equal those ``d`` later."""
        w, most = self.words, len(self.words) - i - d
        lo, hi = self.known.get(d, (0, -1))
        for k in range(min(_FIRST, most)):
            if lo <= i + k < hi:
                return hi - i
            if w[i + k] != w[i + k + d]:
                return k
        if most <= _FIRST:
            return most
        n = self._reach(i, d, most, False)
        if n > _FIRST:
            self.known[d] = (i, i + n)
        return n


def _lyndon_ends(words: list[int], stretches: Stretches) -> list[int]:
    """For each position, where its longest Lyndon word ends: the next smaller suffix, from a stack scanned right to left."""
    n = len(words)
    ends, stack = [n] * n, []
    for i in range(n - 1, -1, -1):
        x = words[i]
        while stack:
            j = stack[-1]
            y = words[j]
            if x > y:
                break
            if x == y:
                same = stretches.ahead(i, j - i)
                if j + same == n or words[i + same] > words[j + same]:
                    break
            stack.pop()
        if stack:
            ends[i] = stack[-1]
        stack.append(i)
    return ends


def find_runs(words: list[int], least_words: int = 6, least_periods: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run, by start and then period; words are compared as numbers."""
    if least_periods < 3:
        raise ValueError("runs of fewer than three periods need not repeat a root that begins in the first")
    n = len(words)
    found: set[tuple[int, int, int]] = set()
    if n < least_words:
        return []
    stretches = Stretches(words)
    for order in (words, [-w for w in words]):
        ends = np.array(_lyndon_ends(order, stretches), np.int64)
        at = np.arange(n)
        period = ends - at
        # a root of a run of this many periods begins in the first of them and is followed by its like
        likely = (ends < n) & (stretches.array[np.minimum(ends, n - 1)] == stretches.array) & (least_periods * period <= n)
        done: dict[int, int] = {}
        for i in np.flatnonzero(likely)[::-1].tolist():
            q = int(period[i])
            if done.get(q, n) <= i:
                continue
            lo, hi = stretches.around(i, q)
            length = hi - lo + q
            if hi > i:
                done[q] = lo
            if length >= max(least_words, least_periods * q):
                found.add((lo, length, q))
    return sorted(found)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, one blank between, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), bool)
    for start, length, q in runs:
        gone[start + q : start + length] = True
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def detect_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", runs: Runs = Runs(),
    edit: Callable[[list[bytes], int | str | None], list[bytes]] | None = None,
) -> DataFrame:
    """``docs`` without ``text``, with n_words, runs and collapsed.

    runs: (start, length, period) of each, in words from 0, by start and then period; collapsed: the text's words, one
    blank between, without those after a run's first period. ``edit``, if given, maps the words and key of a document to
    the words that are searched instead.
    """
    need(docs, key, text)
    docs = docs.drop("n_words", "runs", "collapsed")
    keep = [c for c in docs.columns if c != text]
    at = keep.index(key) if edit else -1
    made = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    one = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found, texts = [], [], []
            for i, x in enumerate(batch.column(0)):
                words = (x.as_py() or b"").split()  # bytes.split parts at exactly the six ASCII white spaces
                if edit:
                    words = edit(words, batch.column(1 + at)[i].as_py())
                numbers: dict[bytes, int] = {}
                some = find_runs([numbers.setdefault(w, len(numbers)) for w in words], runs.least_words, runs.least_periods)
                sizes.append(len(words))
                found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in some])
                texts.append(collapsed(words, some))
            rest = [batch.column(i) for i in range(1, batch.num_columns)]
            columns = [*rest, pa.array(sizes, pa.int64()), pa.array(found, pa.list_(one)), pa.array(texts, pa.large_binary()).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "n_words", "runs", "collapsed"])

    found = docs.select(F.col(text).cast("binary"), *keep).mapInArrow(run, f"{kinds}, {made}")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
