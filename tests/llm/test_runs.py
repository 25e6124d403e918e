"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from thalweg.llm import queries, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def brute_runs(w, least_words=6, least_periods=4):
    n, out = len(w), set()
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least_words, least_periods * q):
                s = w[i : i + length]
                if not any(s[p:] == s[:-p] for p in range(1, q)):
                    out.add((i, length, q))
            i = j + 1
    return sorted(out)


def brute_row(words):
    found = brute_runs(words)
    kept = [x for i, x in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(found), *longest, digest(lines), digest(" ".join(kept)))


def rewritten(words, key):
    h = zlib.crc32(str(key).encode())
    if key is None or h % 10 or not words:
        return words
    n, g, out = len(words), h // 10, list(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    for i in range(a, n):
        out[i] = words[a + (i - a) % p]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_by_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(400):
        k, words = rng.choice([1, 2, 3, 5]), []
        for _ in range(rng.randint(0, 5)):
            words += [rng.randrange(k) for _ in range(rng.randint(1, 8))] * rng.randint(1, 7)
        words += [rng.randrange(k) for _ in range(rng.randint(0, 9))]
        for least in ((6, 4), (1, 3), (10, 5)):
            assert runs.find_runs(words, *least) == brute_runs(words, *least)


def test_colliding_hashes_change_nothing(monkeypatch):
    rng = random.Random(7)
    monkeypatch.setattr(runs, "mixed", lambda x: x * runs.U(0))
    for _ in range(200):
        words = [rng.randrange(2) for _ in range(rng.randint(0, 9))] * rng.randint(1, 30) + [rng.randrange(2) for _ in range(20)]
        assert runs.find_runs(words) == brute_runs(words)


def test_query_by_brute_force(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_lyndon_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        assert got[r.doc_id] == brute_row(rewritten(WORD.findall(r.text or ""), r.doc_id)), r.doc_id
    assert sum(x[0] > 0 for x in got.values()) > 5


def test_awkward_rows(spark):
    texts = [None, "", " \n\t", "a", "a " * 5, "a " * 6, "ä b " * 4, "la la la la la la x y x y x y x y", "deep " * 100_000, "a a a a a a\x0b\x0ca"]
    rows = [(i if i else None, t, "own") for i, t in enumerate(texts)] + [(3, "a", "own")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = runs.detect_runs(df.withColumn("numbers", F.lit("own")))
    assert got.columns == ["doc_id", "numbers", "n_words", "runs", "collapsed"]
    want = sorted((k, len(WORD.findall(t or "")), brute_runs(WORD.findall(t or "")) if len(t or "") < 999 else [(0, 100_000, 1)]) for k, t, _ in rows[1:])
    out = got.where("doc_id is not null").collect()
    assert sorted((r.doc_id, r.n_words, [tuple(x) for x in r.runs]) for r in out) == want
    assert next(r.collapsed for r in out if r.doc_id == 7) == "la x y"
    assert got.where("doc_id is null").first().collapsed == ""
    assert runs.detect_runs(df.where("false")).count() == 0
