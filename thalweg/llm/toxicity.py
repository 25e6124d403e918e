"""Toxicity by multiple-instance learning: sentences score, documents are labelled.

A sentence's probability is the logistic of a bias and the weights of the word parts it shows; a document's is their
noisy-or, one less the product of the complements. Weights are trained from document labels by the gradient of the
noisy-or likelihood, so the sentences that offend are found without being marked. Word parts are letters of four to six
in a row, the ends of words counting as letters; those that toxic documents show significantly more often are kept. They
are matched in one pass over the whole text by an automaton.

Learning takes a bounded sample of the labelled rows (``most_rows``, those of the least hash of the id); counts of word
parts over it are made on the executors. Scoring takes every row and whole text.

Nulls: a null text is empty; null ids and null labels are never learned from; of several labels of one id the greatest
counts. Repeated rows are scored alike. Without labels of both classes no part is kept and all score the same share of
toxic labels. An empty table gives an empty result. Clashing column names are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import need

ENDS = re.compile(r"[.!?\n]")
LETTERS = re.compile(r"[^\W\d_]+")
#: The log odds at which training starts for a span that shows no part.
BIAS = -6.0
OTHERS = re.compile(r"[^\w ]|[\d_]")


@dataclass(frozen=True)
class Learning:
    most_rows: int = 20_000
    sizes: tuple[int, ...] = (4, 5, 6)
    least_gain: float = 12.0
    least_odds: float = 5.0
    most_parts: int = 3000
    rounds: int = 800
    ridge: float = 5e-5


@dataclass(frozen=True)
class Model:
    parts: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float


def normal(text: str) -> str:
    """Lower case with all but letters as spaces, of unchanged length: the words of ``LETTERS``, parted alike."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(x if len(x) == 1 else c for c in text for x in [c.lower()])
    return f" {OTHERS.sub(' ', low)} "


@lru_cache(maxsize=200_000)
def word_parts(word: str, sizes: tuple[int, ...]) -> tuple[str, ...]:
    w = f" {word} "
    return tuple({w[i : i + n] for n in sizes for i in range(len(w) - n + 1)} | {w})


def _automaton(parts: tuple[str, ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, part in enumerate(parts):
        found.add_word(part, (i, len(part)))
    found.make_automaton()
    return found


def sentences(text: str, automaton) -> tuple[int, dict[int, set[int]], list[int]]:
    """How many spans the sentence ends part the text into, the parts of each span that shows any, and the ends."""
    hits = list(automaton.iter(normal(text))) if len(automaton) else []
    if not hits:
        return 1 + sum(text.count(c) for c in ".!?\n"), {}, []
    ends = [m.start() for m in ENDS.finditer(text)]
    shown: dict[int, set[int]] = {}
    for last, (part, size) in hits:
        shown.setdefault(bisect_left(ends, last - size // 2 - 1), set()).add(part)
    return len(ends) + 1, shown, ends


def _counts(texts: DataFrame, learning: Learning) -> DataFrame:
    """(part, toxic, clean): documents of each class that show a word part, summed map-side by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = (Counter(), Counter())
            for text, label in zip(batch.column(0), batch.column(1), strict=True):
                words = set(LETTERS.findall((text.as_py() or "").lower()))
                seen[label.as_py()].update(set().union(*(word_parts(w, learning.sizes) for w in words)))
            parts = [p for p in seen[1] | seen[0] if seen[0][p] + seen[1][p]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.string()), *(pa.array([seen[c][p] for p in parts], pa.int64()) for c in (1, 0))],
                ["part", "toxic", "clean"],
            )

    rows = texts.mapInArrow(run, "part string, toxic long, clean long")
    return rows.groupBy("part").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _instances(texts: DataFrame, parts: tuple[str, ...]) -> list:
    """For each learned document its label, its spans without parts, and the parts of each other span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(parts)
        for batch in batches:
            out = []
            for text, label in zip(batch.column(0), batch.column(1), strict=True):
                n, shown, _ = sentences(text.as_py() or "", automaton)
                out.append({"label": label.as_py(), "plain": n - len(shown), "spans": [sorted(x) for x in shown.values()]})
            kind = pa.schema([("label", pa.int32()), ("plain", pa.int64()), ("spans", pa.list_(pa.list_(pa.int32())))])
            yield pa.RecordBatch.from_pylist(out, kind)

    return texts.mapInArrow(run, "label int, plain long, spans array<array<int>>").collect()


def _gain(toxic: int, clean: int) -> Column:
    """Log likelihood ratio of a part's documents against chance: so many parts are tried that it must be large."""
    both = F.col("toxic") + F.col("clean")
    term = lambda c, n: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (both * (n / (toxic + clean))))).otherwise(0.0)
    return 2 * (term("toxic", toxic) + term("clean", clean))


def fit(texts: DataFrame, learning: Learning = Learning()) -> Model:
    """From (text, label 0 or 1) rows, a bounded sample."""
    sums = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sums.get(1, 0), sums.get(0, 0)
    share = (toxic + 1) / (toxic + clean + 2)
    if not toxic or not clean:
        return Model((), (), log(share / (1 - share)) - 6)
    rate = lambda c, n: (F.col(c) + 0.5) / (n + 1)
    known = _counts(texts, learning).withColumn("odds", rate("toxic", toxic) / rate("clean", clean))
    known = known.where(F.col("odds") >= learning.least_odds).withColumn("gain", _gain(toxic, clean))
    top = known.where(F.col("gain") >= learning.least_gain).orderBy(F.desc("gain"), "part").limit(learning.most_parts).collect()
    parts = tuple(r["part"] for r in top)
    bags = _instances(texts, parts)
    owner = np.array([i for i, b in enumerate(bags) for _ in b["spans"]], np.int64)
    spans = [s for b in bags for s in b["spans"]]
    row = np.array([i for i, s in enumerate(spans) for _ in s], np.int64)
    col = np.array([p for s in spans for p in s], np.int64)
    y = np.array([b["label"] for b in bags], float)
    plain = np.array([b["plain"] for b in bags], float)
    weights, bias = _train(y, plain, owner, row, col, len(spans), len(parts), learning)
    return Model(parts, tuple(float(w) for w in weights), float(bias))


def _first_weights(y, owner, row, col, n_parts) -> np.ndarray:
    """Weights by which a span that shows a part alone has the log odds of the part's documents.

    Parts of one word show together, so each starts with its share of the sum. From smaller weights the likelihood
    would leave those of a word low whose documents other words explain as well.
    """
    seen = np.unique(owner[row] * n_parts + col) if len(row) else np.zeros(0, np.int64)
    doc, part = seen // max(n_parts, 1), seen % max(n_parts, 1)
    toxic = np.bincount(part, y[doc], n_parts)
    clean = np.bincount(part, 1 - y[doc], n_parts)
    beside = np.bincount(col, np.bincount(row)[row] if len(row) else None, n_parts) / np.maximum(np.bincount(col, minlength=n_parts), 1)
    return (np.log((toxic + 0.5) / (clean + 0.5)) - BIAS) / np.maximum(beside, 1)


def _train(y, plain, owner, row, col, n_spans, n_parts, learning) -> tuple[np.ndarray, float]:
    """Adam on the mean noisy-or log likelihood with a ridge."""
    theta = np.concatenate([_first_weights(y, owner, row, col, n_parts), [BIAS]])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    n = len(y)
    for t in range(1, learning.rounds + 1):
        w, b = theta[:-1], theta[-1]
        z = b + np.bincount(row, w[col], n_spans)
        p, p0 = 1 / (1 + np.exp(-np.clip(z, -30, 30))), 1 / (1 + np.exp(-b))
        # log of the chance that nothing offends; 1 - p is the derivative's complement
        none = plain * np.log1p(-p0) + np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), n)
        miss = np.minimum(np.exp(none), 1 - 1e-9)
        by_doc = np.where(y == 1, miss / (1 - miss), -1.0) / n  # d likelihood / d (-none)
        by_span = by_doc[owner] * p
        grad = np.concatenate([np.bincount(col, by_span[row], n_parts), [by_span.sum() + (by_doc * plain * p0).sum()]])
        grad[:-1] -= learning.ridge * w
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        theta = theta + 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-9)
    return theta[:-1], theta[-1]


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with score and offending: (start, end, probability) of sentences at 0.5 or more."""
    need(docs, text)
    docs = docs.drop("score", "offending")
    keep = [c for c in docs.columns if c != text]
    made = "score double, offending array<struct<start: long, end: long, probability: double>>"
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(model.parts)
        weights, bias = model.weights, model.bias
        plain = log1p(-1 / (1 + exp(-bias)))
        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])
        for batch in batches:
            scores, found = [], []
            for x in batch.column(0):
                whole = x.as_py() or ""
                n, shown, ends = sentences(whole, automaton)
                none, bad = plain * (n - len(shown)), []
                for i, parts in shown.items():
                    z = max(-30.0, min(30.0, bias + sum(weights[p] for p in parts)))
                    none += -log1p(exp(z))
                    if z >= 0:
                        start = ends[i - 1] + 1 if i else 0
                        bad.append({"start": start, "end": ends[i] + 1 if i < len(ends) else len(whole), "probability": 1 / (1 + exp(-z))})
                scores.append(1 - exp(none))
                found.append(sorted(bad, key=lambda s: s["start"]))
            rest = [batch.column(i) for i in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(scores), pa.array(found, pa.list_(span))], [*keep, "score", "offending"]
            )

    return docs.select(text, *keep).mapInArrow(run, f"{kinds}, {made}" if kinds else made)


def detect(
    docs: DataFrame, labels: DataFrame, may_learn: Column, label: str = "toxic", key: str = "doc_id", text: str = "text",
    learning: Learning = Learning(),
) -> DataFrame:
    """Scores of all ``docs``; learns from labelled rows for which ``may_learn`` (of the key) holds."""
    need(docs, key, text)
    need(labels, key, label)
    known = labels.where(may_learn & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    some = known.orderBy(F.xxhash64(key), key).limit(learning.most_rows)
    texts = docs.select(key, text).join(F.broadcast(some), key).select(text, "label")  # most_rows bounds it
    return score(docs, fit(texts, learning), text)
