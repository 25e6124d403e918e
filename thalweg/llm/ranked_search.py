"""Ranked lexical search of whole texts by WAND, a shard of documents at a time.

Terms are runs of ASCII letters and digits and of all other than ASCII characters, A-Z in lower case. With N documents
that have a term, L terms in all and n in a document, a term of document frequency df weighs
``floor(1000 ln((2 N + 2) / (2 df + 1)))``; one found tf times in a document whose length term is
``m = 25 + (75 n N) div L`` adds weight * ((10^9 tf) div (1000 tf + 8 m)), as often as the query repeats it.

Queries are taken in blocks of about ``block_terms`` terms (one query of more is a block of its own). For each block the
corpus is read once into postings of the block's terms alone, written to the shared folder; all statistics come from
them. A shard is a partition of that table, so its size is bounded by the size of partitions and never by a term: a term
that every document has is split like the documents. In a shard, documents lie in the order of their keys and each term
knows its largest impact there. A query moves its cursors by pivots: in the order of the documents they stand at, the
largest impacts add up until they exceed the least score of the heap, and no document before that pivot can beat it.
The heap's threshold starts from exact scores of documents that hold the query's rarest terms. What the shards' heaps
hold is merged by score and key, a window over at most ``best`` rows a query and shard.

Nulls: a null text has no terms; null keys come last among equal scores; each row is a document, whether or not its key
repeats, and each row of the queries is one, so a repeated item has rows for each. A query without terms, or of terms
that no document has, has no rows. Empty tables give an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from heapq import heappush, heapreplace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import need, written

#: All bytes that part terms become blanks, A-Z become a-z.
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
_POSTINGS = "n long, terms array<int>, tfs array<int>"


@dataclass(frozen=True)
class Search:
    best: int = 10
    block_terms: int = 100_000


def terms_of(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order."""
    return raw.translate(_PLAIN).split()


def blocks(queries: DataFrame, item: str, text: str, most: int) -> Iterator[list[tuple[object, Counter]]]:
    """Runs of queries as (item, terms), of about ``most`` terms together."""
    block, size = [], 0
    for row in queries.select(F.col(item), F.col(text).cast("binary")).toLocalIterator():
        found = Counter(terms_of(bytes(row[1] or b"")))
        if not found:
            continue
        if block and size + len(found) > most:
            yield block
            block, size = [], 0
        block.append((row[0], found))
        size += len(found)
    if block:
        yield block


def postings(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """(key, n, terms, tfs) of each document that has a term: its length and its terms of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, tfs = [], [], []
            for x in batch.column(1):
                every = terms_of(x.as_py() or b"")
                found = Counter(map(vocabulary.get, every))
                found.pop(None, None)
                sizes.append(len(every))
                terms.append(list(found))
                tfs.append(list(found.values()))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))]
            out = pa.RecordBatch.from_arrays(columns, ["key", "n", "terms", "tfs"])
            yield out.filter(pc.greater(out.column(1), 0))

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text).cast("binary")).mapInArrow(run, f"key {kind}, {_POSTINGS}")


class Shard:
    """Postings of one shard: documents by ascending key, and for each term its documents, impacts and largest impact."""

    def __init__(self, table: pa.Table, weights: np.ndarray, n_docs: int, n_terms: int):
        order = pc.sort_indices(table.column("key"), null_placement="at_end")
        table = table.take(order).combine_chunks()
        self.keys = table.column("key")
        length = 25 + 75 * table.column("n").to_numpy() * n_docs // n_terms
        flat = lambda name: pc.list_flatten(table.column(name)).to_numpy().astype(np.int64)
        per = pc.fill_null(pc.list_value_length(table.column("terms")), 0).to_numpy()
        doc, term, tf = np.repeat(np.arange(len(per)), per), flat("terms"), flat("tfs")
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * length[doc]))
        by_term = np.argsort(term, kind="stable")
        self._doc, self._impact = doc[by_term], impact[by_term]
        self._begins = np.searchsorted(term[by_term], np.arange(len(weights) + 1))
        self._lists: dict[int, tuple[array, array, int]] = {}

    def term(self, t: int) -> tuple[array, array, int]:
        """Documents that hold the term, its impact in each, and the largest."""
        if t not in self._lists:
            lo, hi = self._begins[t], self._begins[t + 1]
            own = self._impact[lo:hi]
            self._lists[t] = (array("q", self._doc[lo:hi].tobytes()), array("q", own.tobytes()), int(own.max()) if hi > lo else 0)
        return self._lists[t]

    def exact(self, docs: np.ndarray, query: list[tuple[int, int]]) -> np.ndarray:
        """Scores of a few documents."""
        scores = np.zeros(len(docs), np.int64)
        for t, times in query:
            lo, hi = self._begins[t], self._begins[t + 1]
            at = lo + np.searchsorted(self._doc[lo:hi], docs)
            there = (at < hi) & (self._doc[np.minimum(at, len(self._doc) - 1)] == docs)
            scores[there] += times * self._impact[at[there]]
        return scores

    def floor(self, query: list[tuple[int, int]], best: int) -> int:
        """A score that at least ``best`` documents reach (0 if fewer hold a term): of those with the rarest terms."""
        by_size = sorted(query, key=lambda q: self._begins[q[0] + 1] - self._begins[q[0]])
        some = np.zeros(0, np.int64)
        for t, _ in by_size:
            some = np.union1d(some, self._doc[self._begins[t] : self._begins[t + 1]][: 4 * best])
            if len(some) >= 4 * best:
                break
        return int(np.sort(self.exact(some, query))[-best]) if len(some) >= best else 0


def wand(shard: Shard, query: list[tuple[int, int]], best: int) -> list[tuple[int, int]]:
    """(score, document) of the ``best`` documents with the highest scores above 0, equal ones in ascending order."""
    lists = [(*shard.term(t), times) for t, times in query]
    lists = [(docs, impacts, most * times, times) for docs, impacts, most, times in lists if most * times > 0]
    at = [0] * len(lists)
    cursors = sorted((docs[0], i) for i, (docs, *_) in enumerate(lists))
    threshold = max(0, shard.floor(query, best) - 1)
    heap: list[tuple[int, int]] = []
    while cursors:
        most = 0
        for k, (_, i) in enumerate(cursors):
            most += lists[i][2]
            if most > threshold:
                break
        else:
            break
        pivot = cursors[k][0]
        moved = []
        if cursors[0][0] == pivot:
            score, k = 0, 0
            for doc, i in cursors:
                if doc != pivot:
                    break
                docs, impacts, _, times = lists[i]
                score += times * impacts[at[i]]
                at[i] += 1
                k += 1
                if at[i] < len(docs):
                    moved.append((docs[at[i]], i))
            if score > threshold:
                if len(heap) < best:
                    heappush(heap, (score, -pivot))
                else:
                    heapreplace(heap, (score, -pivot))
                if len(heap) == best:
                    threshold = max(threshold, heap[0][0])
        else:
            for _, i in cursors[:k]:
                docs = lists[i][0]
                at[i] = bisect_left(docs, pivot, at[i])
                if at[i] < len(docs):
                    moved.append((docs[at[i]], i))
        cursors = sorted(moved + cursors[k:])
    return [(score, -doc) for score, doc in sorted(heap, key=lambda h: (-h[0], -h[1]))]


def _ranked(table: DataFrame, block: list, weights: np.ndarray, vocabulary: dict, n_docs: int, n_terms: int, best: int) -> DataFrame:
    """(query, key, score): each shard's best of each query."""
    asked = [sorted((vocabulary[t], times) for t, times in found.items()) for _, found in block]
    kind = table.schema["key"].dataType.simpleString()
    names = ["query", "key", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        shard = Shard(pa.Table.from_batches(held), weights, n_docs, n_terms)
        del held
        number, doc, scores = [], [], []
        for q, query in enumerate(asked):
            found = wand(shard, query, best)
            number += [q] * len(found)
            scores += [s for s, _ in found]
            doc += [d for _, d in found]
        keys = shard.keys.take(pa.array(doc, pa.int64())).combine_chunks()
        keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) and keys.num_chunks else pa.array([], shard.keys.type) if not doc else keys
        yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), keys, pa.array(scores, pa.int64())], names)

    return table.mapInArrow(run, f"query int, key {kind}, score long")


def search(
    docs: DataFrame, queries: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text", options: Search = Search()
) -> DataFrame:
    """(item, rank, key, score): the documents with the highest scores above 0 for each query, rank 1 the highest."""
    need(docs, key, text)
    need(queries, item, text)
    spark, found = docs.sparkSession, []
    kind = queries.schema[item].dataType
    for block in blocks(queries, item, text, options.block_terms):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}))}
        table = written(postings(docs, vocabulary, key, text))
        totals = table.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        frequencies = table.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # at most the vocabulary
        n = totals["docs"]
        if not n:
            continue
        df = np.zeros(len(vocabulary), np.int64)
        for row in frequencies:
            df[row["term"]] = row["count"]
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        heaps = written(_ranked(table, block, weights, vocabulary, n, totals["terms"], options.best))
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
        best = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= options.best)
        items = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], f"query int, item {kind.simpleString()}")
        found.append(best.join(F.broadcast(items), "query").select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score"))
    if not found:
        return spark.createDataFrame([], f"`{item}` {kind.simpleString()}, rank int, `{key}` {docs.schema[key].dataType.simpleString()}, score long")
    return reduce(DataFrame.unionByName, found)


#: The ten best of each benchmark item, in DuckDB's SQL.
SEARCH_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term
), lengths AS (
  SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), totals AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths
), held AS (
  SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM held, totals GROUP BY term
), impacts AS (
  SELECT h.doc_id, h.term, w.weight * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (25 + (75 * l.n * t.docs) // t.terms))) AS impact
  FROM held h JOIN weights w ON w.term = h.term JOIN lengths l ON l.doc_id = h.doc_id, totals t
), scored AS (
  SELECT a.item_id, i.doc_id, CAST(sum(a.times * i.impact) AS BIGINT) AS score
  FROM asked a JOIN impacts i ON i.term = a.term GROUP BY a.item_id, i.doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
