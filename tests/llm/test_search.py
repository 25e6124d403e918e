"""WAND against scores of all documents."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from thalweg.llm import ranked_search
from thalweg.llm.common import written

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute_search(docs, queries, best=10):
    held = [(k, Counter(terms(t))) for k, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in queries:
        asked, scored = Counter(terms(text)), []
        for k, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms if n_terms else 0
            score = 0
            for t, times in asked.items():
                if c[t]:
                    score += times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, k is None, k))
        out += [(item, i + 1, k, -s) for i, (s, _, k) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:best])]
    return out


def test_terms():
    for t in ("", "Hello, WORLD_1x", "naïve Ünder\x7fx漢 字\x80", "a\x00b-[c]{d}@e`f", "ÄÖ z9"):
        assert [x.decode() for x in ranked_search.terms_of(t.encode())] == terms(t)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_search_by_brute_force(spark, seed):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(i, text(rng.choice([1, 3, 20, 100, 400]))) for i in range(600)]
    docs += [(1000 + i, docs[rng.randrange(600)][1]) for i in range(100)]  # copies tie
    docs += [(5000, None), (5001, ""), (5002, "?!"), (None, docs[3][1]), (None, "w1 w2 w3"), (3, docs[3][1]), (6000, "w1 " * 30_000)]
    rng.shuffle(docs)
    queries = [(i, docs[rng.randrange(600)][1] if i % 2 else text(12)) for i in range(20)]
    queries = [(i, (t or "")[:300]) for i, t in queries] + [(90, None), (91, "zzz unknown"), (92, "w1"), (92, "w1"), (None, "w2 w2 W2")]
    d = written(spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("own")).repartition(3))
    q = spark.createDataFrame(queries, "item_id long, text string")
    want = sorted(brute_search(docs, queries), key=str)
    assert sorted(map(tuple, ranked_search.search(d, q).collect()), key=str) == want
    few = ranked_search.Search(block_terms=30)
    assert sorted(map(tuple, ranked_search.search(d, q, options=few).collect()), key=str) == want


def test_documents_are_skipped(spark):
    """Most documents hold frequent words alone; few of them are scored."""
    rng = random.Random(5)
    docs = [(i, "the of and " * rng.randint(1, 9) + (f"rare{i % 7} word{i % 11}" if i % 50 == 0 else "")) for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    vocabulary = {b"and": 0, b"of": 1, b"rare0": 2, b"the": 3, b"word0": 4}
    import numpy as np
    import pyarrow as pa

    rows = ranked_search.postings(df.coalesce(1), vocabulary, "doc_id", "text").toArrow()
    assert isinstance(rows, pa.Table)
    shard = ranked_search.Shard(rows, np.array([2, 2, 9000, 2, 8000]), 3000, 50_000)
    scored = []
    heap = ranked_search.heappush
    seen = ranked_search.heapreplace
    try:
        ranked_search.heappush = lambda h, x: (scored.append(x), heap(h, x))
        ranked_search.heapreplace = lambda h, x: (scored.append(x), seen(h, x))
        found = ranked_search.wand(shard, [(t, 1) for t in range(5)], 3)
    finally:
        ranked_search.heappush, ranked_search.heapreplace = heap, seen
    every = sorted(((-s, i) for i, s in enumerate(shard.exact(np.arange(3000), [(t, 1) for t in range(5)]).tolist())))[:3]
    assert [(-s, i) for s, i in found] == every and len(scored) < 60


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search.search(d.where("false"), q).count() == 0
    assert ranked_search.search(d, q.where("false")).count() == 0
    assert ranked_search.search(d, q).columns == ["item_id", "rank", "doc_id", "score"]
    assert ranked_search.search(d, q).collect()[0].rank == 1
