"""Corpus operators against brute force, exact round trips and held-out labels, with awkward rows in every table."""

import base64
import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from thalweg.llm import (
    imatch, jaccard_join, mixing, packing, quality_classifier, quality_rules, quotations, sharding, text_stats, toxicity, warc,
)
from thalweg.llm.common import crc_mod, range_bounds, range_of
from thalweg.llm.components import components
from thalweg.llm.queries import byte_bpe

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
KINDS = "doc_id long, text string, lang string, source string, n_chars long, score string, size string, kept string, slot string"


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in any column, empty and long texts, ties and repeated rows, and columns whose names clash."""
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice("the river runs to a wide and quiet sea by old stone mills".split()) + rng.choice(["", "", ",", "."]) for _ in range(n))
    base = prose(60)
    texts = {1: base, 2: base, 3: base.replace("river", "River", 1), 4: "", 5: None, 6: " \t\n", 7: "one two", 8: "one two", 9: prose(4000)}
    texts |= {10 + i: prose(rng.randint(1, 90)) for i in range(30)} | {50: "same words again and again " * 30, 51: "línea öß 漢字\nlínea öß 漢字\n"}
    rows = [(k, t, "en" if k % 2 else None, f"s{k % 3}" if k % 5 else None, None, "x", "y", "z", "w") for k, t in texts.items()]
    return spark.createDataFrame([*rows, rows[0], rows[6], (None, base, None, None, 1, None, None, None, None)], KINDS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KINDS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def brute_counts(t):
    w = WORD.findall(t or "")
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("table", ["awkward", "documents"])
def test_base_counts(request, table):
    df = request.getfixturevalue(table)
    got = text_stats.with_statistics(df.select("text", F.col("text").alias("t")), text_stats.base_statistics)
    for r in got.select("__s.*", "__doc.t").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(r.t)


def test_range_search(spark):
    values = [(v,) for v in [*range(0, 3000, 3), 10**15, -5, None]]
    df = spark.createDataFrame(values, "k long")
    bounds = range_bounds(df, "k", 70)
    for r in df.select("k", range_of(F.col("k"), bounds).alias("at")).collect():
        want = max([i for i, b in enumerate(bounds) if r.k is not None and b <= r.k], default=0)
        assert r["at"] == want
    assert range_bounds(df.where("false"), "k", 3) == []


def test_quality_scores_held_out_labels(documents, labels, awkward, empty):
    learn = F.coalesce(crc_mod(F.col("doc_id"), 4) != 2, F.lit(False))
    scored = quality_classifier.classify(documents, labels, learn)
    held = scored.join(labels, "doc_id").where(crc_mod(F.col("doc_id"), 4) == 2).collect()
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in held]) >= 0.9
    got = quality_classifier.classify(awkward, labels, learn).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 for r in got)
    assert quality_classifier.classify(empty, labels.where("false"), learn).count() == 0
    alone = quality_classifier.classify(awkward, labels.where("quality = 1"), learn).collect()
    assert all(0 <= r.score <= 1 for r in alone)
    kept = quality_classifier.accepted(awkward, labels, learn, 0.0)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()


def test_rules_reject_outliers_only(spark, awkward, empty):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(30, 200))), "en", "s") for i in range(200)]
    odd = (999, " ".join(f"{word()}{m}" for m in ["###", "$$$", "%%%", "&&&"] * 30), "en", "s")
    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame([*rows, odd], "doc_id long, text string, lang string, source string")).collect()}
    assert not got[999].kept and not got[999].base_failed
    assert all(got[i].kept for i in range(200))
    judged = quality_rules.judge(awkward).collect()
    assert len(judged) == awkward.count()
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in judged)
    assert all(not (r.kept and r.base_failed) for r in judged)
    assert quality_rules.judge(empty).count() == 0
    assert quality_rules.passing(awkward).columns == awkward.columns


def shingle_set(t):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_groups(rows):
    sets = {k: shingle_set(t) for k, t in rows}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(s), find(k)) for k, s in sets.items()}


def near_copies(seed):
    """Groups of copies whose edits accumulate, around the threshold, of many lengths, with a passage that all share."""
    rng = random.Random(seed)
    passage, rows = [f"p{i}" for i in range(40)], []
    for g in range(25):
        words = [f"g{g}w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 6, 9, 12, 30, 60, 150, 400]))] + passage * (g % 2)
        for _ in range(6):
            rows.append((len(rows) + 1, " ".join(words)))
            for _ in range(max(1, len(words) // rng.choice([20, 40, 60]))):
                words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_join_loses_no_link(spark, seed):
    rows = near_copies(seed)
    join = jaccard_join.Join(common_least=10, common_share=0.05, signatures_per_bucket=500)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.group(spark.createDataFrame(rows, "doc_id long, text string"), join).collect()}
    assert got == brute_groups(rows)


def chained_copies(seed):
    """Short documents of which each adds a word to the one before it, or is shifted by one."""
    rng = random.Random(seed)
    rows = []
    for g in range(60):
        n, steps = rng.randint(8, 30), rng.randint(3, 8)
        words = [f"c{g}w{i}" for i in range(n + steps)]
        for i in range(steps):
            rows.append((len(rows) + 1, " ".join(words[: n + i] if g % 2 else words[i : n + i])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_join_loses_no_link_of_small_crowds(spark, seed):
    rows = chained_copies(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.group(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_groups(rows)


def test_join_of_documents_and_awkward_rows(documents, awkward, empty):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.group(documents).collect()}
    assert got == brute_groups(rows)
    rows = {r.doc_id: r.text for r in awkward.collect() if r.doc_id is not None}
    out = jaccard_join.group(awkward).collect()
    assert len(out) == awkward.count()
    want = brute_groups(rows.items())
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in out if r.doc_id is not None)
    assert jaccard_join.group(empty).count() == 0
    assert jaccard_join.deduplicated(awkward).columns == awkward.columns


def brute_components(rows):
    """For each row, its set's size and the least id that links reach; ids may be null or repeated."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted(((k, len(sets[i]), least.get(find(i)) if sets[i] else k) for i, (k, _) in enumerate(rows)), key=str)


def grouped(spark, rows, join=jaccard_join.Join()):
    return sorted(map(tuple, jaccard_join.group(spark.createDataFrame(rows, "doc_id long, text string"), join).collect()), key=str)


def edited_copies(rng, name, n, copies, most):
    """Copies of one text of ``n`` words, each with up to ``most`` words replaced, dropped or repeated, some edits alike."""
    words = [f"{name}{i}" for i in range(n)]
    common = [rng.randrange(n) for _ in range(6)]
    out = []
    for c in range(copies):
        w = list(words)
        for e in range(rng.randint(0, most)):
            i = rng.choice(common) if rng.random() < 0.3 else rng.randrange(len(w))
            i = min(i, len(w) - 1)
            kind = rng.randrange(3)
            w[i : i + 1] = [f"x{c}y{e}"] if kind == 0 else [] if kind == 1 else [w[i], w[i]]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_families_lose_no_link(spark, seed):
    """Large crowds in which most pairs lie just above or below the similarity asked."""
    rng = random.Random(seed)
    texts = [t for g in range(6) for t in edited_copies(rng, f"g{g}w", rng.randint(20, 160), 40, 9)]
    texts += [" ".join(f"p{i}" for i in range(60)) + " " + " ".join(f"d{d}q{i}" for i in range(rng.randint(5, 40))) for d in range(40)]
    texts += [f"alone{i}" for i in range(30)] + [f"a{i % 3} b c d e f g h i{i}" for i in range(30)]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 1))
    join = jaccard_join.Join() if seed == 1 else jaccard_join.Join(pivots=1, common_least=5, common_share=0.02)
    assert grouped(spark, rows, join) == brute_components(rows)


def test_small_crowds_around_a_similar_pair(spark):
    """A passage gathers a similar pair and one to four sets that are like neither."""
    rows = []
    for g in range(48):
        passage, unlike = " ".join(f"s{g}s{i}" for i in range(40)), 1 + g % 4
        tail = " ".join(f"g{g}t{i}" for i in range(20))
        more = [f"{passage} {tail}", f"{passage} {tail} end"] + [passage + " " + " ".join(f"g{g}u{u}v{i}" for i in range(20)) for u in range(unlike)]
        rows += [(100 * g + i, t) for i, t in enumerate(more)]
    assert grouped(spark, rows) == brute_components(rows)


def test_links_through_null_and_repeated_ids(spark):
    rows = []
    for g, middle in enumerate((None, 12, 21, 33)):
        words = [f"g{g}w{i}" for i in range(60)]
        p, q, r = (" ".join(words[i : i + 50]) for i in (0, 4, 8))
        rows += [(10 * g + 1, p), (middle, q), (10 * g + 3, r)]
    other = [f"v{i}" for i in range(60)]
    more = [(5, "p " * 9), (5, " ".join(other[:50])), (6, " ".join(other[4:54])), (None, "a b c d e f"), (None, "a b c d e f"), (None, None)]
    assert grouped(spark, rows + more) == brute_components(rows + more)
    rows = more
    kept = jaccard_join.deduplicated(spark.createDataFrame([*rows, rows[0], rows[1]], "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[1], rows[3], rows[5]], key=str)


def test_parity_sketches_bound_the_difference():
    rng = np.random.default_rng(0)
    for n in (3, 40, 700):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[n // 4 :], rng.integers(0, 2**63, n // 2 + 1).astype(np.uint64)]))
        both = np.concatenate([a, b])
        begins = np.array([0, len(a), len(a) + len(b)])
        x, y = jaccard_join.sketches(both, begins)
        assert jaccard_join._differ(x, y) <= len(np.setxor1d(a, b))


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 51), (52, 51), (7, 7)], "a long, b long")
    got = dict(components(links).collect())
    assert got == {**{i: 1 for i in range(2, 41)}, 51: 50, 52: 50}


def test_mix_meets_its_targets(awkward, empty, documents):
    for df in (awkward, documents):
        rows = mixing.mix(mixing.sized(df)).collect()
        assert len(rows) == df.count()
        by = {}
        for r in rows:
            assert 0 <= r.taken <= 3 * r.size and r.taken == sum(t.words for t in r.takes) and {t.words for t in r.takes} <= {r.size}
            assert (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= 1)
            by.setdefault(r.source, []).append(r)
        total = sum(r.size for r in rows)
        names = sorted((s for s in by if s is not None)) + [None] * (None in by)
        weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        free, left, targets = {s for s in names}, float(total), {}
        while free:
            share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
            over = {s for s in free if share[s] > 3 * by[s][0].source_size}
            if not over:
                targets |= share
                break
            for s in over:
                targets[s] = 3.0 * by[s][0].source_size
                left -= targets[s]
            free -= over
        for s, group in by.items():
            assert group[0].target == pytest.approx(targets[s]) and 2 * abs(sum(r.taken for r in group) - targets[s]) <= max(r.size for r in group) + 1
    assert mixing.mix(mixing.sized(empty)).count() == 0


def test_training_order_sorts_whole_documents(documents):
    takes = {}
    for r in mixing.mix(mixing.sized(documents)).collect():
        for t in r.takes:
            takes[(t.position, r.source, r.doc_id, t.epoch)] = r.doc_id
    rows = mixing.training_order(documents).collect()
    assert [r.doc_id for r in rows] == [takes[k] for k in sorted(takes)]
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert all(texts[r.doc_id] == r.text for r in rows)


def check_packing(rows, texts):
    encode = packing.encoder(byte_bpe())
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for k, t in texts.items():
        ids = np.array([*encode(t or ""), 0], "<u4")
        at = 0
        for r in sorted(docs[k], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    return sum(r.length for r in rows), len(sequences)


def test_packing_round_trip(documents, awkward, empty):
    tokens, windows = check_packing(packing.pack_documents(documents, byte_bpe()).collect(), {r.doc_id: r.text for r in documents.collect()})
    assert windows * 1024 <= tokens * 1.03 + 1024 * documents.rdd.getNumPartitions()
    unique = awkward.dropDuplicates(["doc_id"])
    check_packing(packing.pack_documents(unique, byte_bpe()).collect(), {r.doc_id: r.text for r in unique.collect()})
    assert packing.pack_documents(empty, byte_bpe()).count() == 0


def test_ids_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(byte_bpe())
    texts = ["", "plain words", " lead\n\n two  spaces ", "don't I'll", "漢字 öß x²", "a <|endoftext|> b", "123 4 5.6", " x y"]
    for t in texts:
        assert packing.encoder(byte_bpe())(t) == own.encode(t, add_special_tokens=False).ids
    long = " ".join(f"word{i} and-so on,\n" for i in range(3000))
    assert [i for p in packing.parts(long, 1000) for i in packing.encoder(byte_bpe())(p)] == own.encode(long, add_special_tokens=False).ids


def test_differencing_balances():
    rng = random.Random(1)
    for n in (0, 1, 5, 300):
        sizes = [rng.randint(1, 512) for _ in range(n)]
        windows = packing.pack(sizes, 1024)
        assert sorted(i for w in windows for i in w) == list(range(n))
        assert all(sum(sizes[i] for i in w) <= 1024 for w in windows)
        assert len(windows) <= -(-sum(sizes) // 1024) * 1.05 + 1


def jump(key, n):
    key, b, j = (key or 0) % 2**64, -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_shards_by_the_published_law(awkward, empty, documents):
    for df in (awkward, documents):
        rows = sharding.assign(df.select("doc_id", "text", "source"), rows_per_range=16).collect()
        assert len(rows) == df.count()
        slots = {}
        for r in rows:
            assert (r.shard, r.grown_shard) == (jump(r.doc_id, 24), jump(r.doc_id, 25))
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = {r.doc_id: (r.size, r.text_crc32) for r in sharding.assign(documents.select("doc_id", "text")).collect()}
    for r in documents.collect():
        raw = (r.text or "").encode()
        assert sizes[r.doc_id] == (len(raw) + 8, zlib.crc32(raw))
    assert sharding.assign(empty).count() == 0


def test_shards_of_large_and_negative_keys(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 12345678901234]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: (r.j.now, r.j.grown) for r in df.select("k", sharding.jumps(F.col("k"), 100).alias("j")).collect()}
    assert got == {k: (jump(k, 100), jump(k, 101)) for k in keys}


def test_fingerprints_of_edited_texts(documents, awkward, empty):
    band = imatch.Lexicon(rows_per_range=16)
    rows = imatch.fingerprints(documents.select("doc_id", "text"), band).collect()
    texts = {r.doc_id: r.text or "" for r in rows}
    ids = sorted(texts)
    prints = {r.doc_id: r for r in rows}
    for i, k in enumerate(ids):
        t, n = texts[k], texts[ids[(i + 1) % len(ids)]]
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        assert prints[k].n_chars == len(t)
        assert prints[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints[k].next == prints[ids[(i + 1) % len(ids)]].fingerprint
    by_text = {}
    for k, t in texts.items():
        by_text.setdefault(t, set()).add(tuple(prints[k].fingerprint))
    assert all(len(x) == 1 for x in by_text.values())
    assert imatch.fingerprints(awkward, band).count() == awkward.count()
    assert imatch.fingerprints(empty, band).count() == 0


def spark_hash(*values):
    """Spark's xxhash64 of strings, longs (or pairs of a value and its bytes) one after the other."""
    import xxhash

    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v if isinstance(v, bytes) else struct.pack("<q", v)
        seed = xxhash.xxh64(data, seed=seed & (1 << 64) - 1).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def brute_fingerprint(text, lexicon, band):
    every = {spark_hash(w) for w in re.split(r"[\x00-\x2F:-@\[-`{-\x7F]+", text.lower()) if w}
    room, parts = 61 - band.parts.bit_length(), {}
    for t in every & lexicon:
        lot = spark_hash(t, struct.pack("<i", 1))
        for j in range(band.levels):
            if lot % band.spread**j == 0:
                part = (lot & (1 << 64) - 1) >> (64 - (band.parts - 1).bit_length())
                parts.setdefault(band.parts * j + part, []).append((part << room) + ((t & (1 << 64) - 1) >> (65 - room)))
    hex_ = lambda h: f"{h % (1 << 32):08x}"
    row = [hex_(spark_hash(*sorted(parts[i]))) if i in parts else "" for i in range(band.levels * band.parts)]
    return row + ["" if parts else hex_(spark_hash(*sorted(every)) if every else spark_hash(text))]


def brute_likeness(a, b, band):
    if a == b:
        return 1.0
    some = equal = 0
    for j in range(band.levels):
        pairs = [(x, y) for x, y in list(zip(a, b))[band.parts * j : band.parts * (j + 1)] if x or y]
        if 2 * len(pairs) <= band.parts or j == band.levels - 1:
            some, equal = some + len(pairs), equal + sum(x == y for x, y in pairs)
    return equal / some if some else 0.0


def test_fingerprints_and_likeness_by_brute_force(documents):
    band = imatch.Lexicon()
    lexicon = {r.term for r in imatch.lexicon(documents, band).collect()}
    counts = Counter(t for r in documents.collect() for t in {spark_hash(w) for w in re.split(r"[\x00-\x2F:-@\[-`{-\x7F]+", (r.text or "").lower()) if w})
    n = documents.count()
    assert lexicon == {t for t, c in counts.items() if max(2, 0.001 * n) <= c <= max(2, 0.2 * n)}
    df = imatch.fingerprints(documents.select("doc_id", "text"))
    near = [imatch.likeness(F.col("fingerprint"), F.col(c)).alias(f"near_{c}") for c in ("edited", "next")]
    rows = {r.doc_id: r for r in df.select("*", *near).collect()}
    for r in rows.values():
        if len(r.text) < 3000:
            assert r.fingerprint == brute_fingerprint(r.text, lexicon, band)
        assert r.near_edited == pytest.approx(brute_likeness(r.fingerprint, r.edited, band))
        assert r.near_next == pytest.approx(brute_likeness(r.fingerprint, r.next, band))
    assert np.mean([r.near_edited for r in rows.values()]) > 10 * np.mean([r.near_next for r in rows.values()])


def test_texts_without_band_terms_are_like_their_equals_only(spark):
    rows = [(i, t) for i, t in enumerate(["漢字", "漢字", "語", "", None, "???", "!!", "zork", "zork  "])]
    band = imatch.Lexicon(least=100)
    got = [r.fingerprint for r in imatch.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), band).orderBy("doc_id").collect()]
    like = [[brute_likeness(a, b, band) for b in got] for a in got]
    equal = [[1.0 if i == j or {i, j} in ({0, 1}, {3, 4}, {7, 8}) else 0.0 for j in range(9)] for i in range(9)]
    assert like == equal


#: (page_id, url, html): equal payloads, nulls, empties, repeated rows and ids, a line break in a URL, a long payload.
PAGES = [
    (1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (9, "http://c/", "<p>x</p>"), (3, "u", None), (4, "u", ""),
    (5, "u\r\nv", "é" * 5000), (None, "u", "<p>x</p>"), (1, "http://a/", "<p>x</p>"), (6, "u", "é" * 5000),
]


def test_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, payload string")
    archives = warc.write_archives(pages, f"file://{tmp_path}/a")
    rows = warc.read_archives(archives).collect()
    assert len(rows) == len(PAGES)
    keeper = {}
    for k, _, html in PAGES:
        if k is not None:
            keeper[html or ""] = max(keeper.get(html or "", k), k)
    want = Counter()
    for k, url, html in PAGES:
        raw, first = (html or "").encode(), keeper[html or ""]
        kind = "response" if k == first else "revisit"
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want[(k, None if url is None else url.replace("\r\n", " "), kind, raw if kind == "response" else None, len(raw), digest, None if kind == "response" else first)] += 1
    assert Counter((r.page_id, r.url, r.record_type, None if r.payload is None else bytes(r.payload), r.payload_bytes, r.payload_digest, r.refers_to) for r in rows) == want
    none = warc.write_archives(pages.where("false"), f"file://{tmp_path}/b")
    assert warc.read_archives(none).count() == 0


def test_dictionary_frame_and_damage(spark, tmp_path):
    import zstandard

    words = zstandard.train_dictionary(2000, [(f"page {i} of a common kind of text " * 20).encode() for i in range(200)]).as_bytes()
    record = warc._record(1, "u", b"abc", "response", 3, base64.b32encode(hashlib.sha1(b"abc").digest()).decode(), None, "2020-01-01T00:00:00Z")
    press = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words))
    for stored in (words, zstandard.ZstdCompressor().compress(words)):
        raw = struct.pack("<II", warc.DICTIONARY_FRAME, len(stored)) + stored + press.compress(record) * 2
        (tmp_path / "x.warc.zst").write_bytes(raw)
        with open(tmp_path / "x.warc.zst", "rb") as f:
            assert [warc.parse(x)["payload"] for x in warc.frames(f)] == [b"abc"] * 2
    for bad in (record.replace(b"abc", b"abd"), record.replace(b"WARC/1.1", b"WARC/2"), record[:-1], record.replace(b"WARC-Date", b"WARC-Dote")):
        with pytest.raises(ValueError):
            warc.parse(bad)
    (tmp_path / "cut.warc.zst").write_bytes(raw[:-3])
    paths = spark.createDataFrame([(str(tmp_path / "cut.warc.zst"),)], "path string")
    rows = warc.read_archives(paths, strict=False).collect()
    assert len(rows) == 2 and rows[0].error is None and "cut short" in rows[1].error


def test_toxic_sentences_are_found(spark, labels, awkward, empty):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    rows, marks = [], []
    for i in range(400):
        lines = [" ".join(word() for _ in range(8)) + "." for _ in range(rng.randint(1, 12))]
        if i % 5 == 0:
            at = rng.randrange(len(lines))
            lines[at] = f"{word()} zork{word()} {word()} grumkle."
        rows.append((i, "\n".join(lines)))
        marks.append((i, int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(marks, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.detect(docs, known, F.col("doc_id") % 4 != 1).collect()}
    held = [i for i, _ in rows if i % 4 == 1]
    assert np.mean([(got[i].score >= 0.7) == (i % 5 == 0) for i in held]) >= 0.98
    for i, t in rows:
        for s in got[i].offending:
            assert "grumkle" in t[s.start : s.end] or "zork" in t[s.start : s.end]
    out = toxicity.detect(awkward, labels, F.lit(True)).collect()
    assert len(out) == awkward.count() and all(0 <= r.score <= 1 for r in out)
    assert toxicity.detect(empty, labels.where("false"), F.lit(True)).count() == 0


def test_quotations(spark):
    rows = [
        (1, 0, "user", "Hello there friend.\nHow are you?"), (1, 1, "assistant", "> How are you?\nFine, thanks."),
        (1, 2, "user", "> Hello there  FRIEND.\n> > deeper\n>> more deep\nGood."), (1, 3, "assistant", ">> How are you?\n> Fine, thanks.\nyes"),
        (2, 0, "user", "> good.\nother"), (2, 1, None, None), (None, 0, "x", "y"), (2, 1, None, None), (3, None, "user", ""),
    ]
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, body string")
    got = quotations.conversations(df).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert [(by[1, i].reply_to, by[1, i].by_quote, by[1, i].n_quotes, by[1, i].max_level) for i in range(4)] == [(None, False, 0, 0), (0, True, 1, 1), (0, True, 2, 2), (1, True, 2, 2)]
    assert by[1, 2].body == "Good." and by[2, 0].body == "other" and by[2, 0].n_linked == 1 and by[2, 0].reply_to is None
    for c in (1, 2, 3, None):
        assert sorted(r.reply_order for r in got if r.conv_id == c) == list(range(sum(r[0] == c for r in rows)))
    assert all(">" not in r.body for r in got)
    assert quotations.conversations(df.where("false")).count() == 0


INNER = """x_length z_length n_words word_chars n_echo_words stratum fine start edge log_det salt m_z_length d2 lang_ ramp ranges words
epoch take takes position source_size target size source_ r wrap ghost key h next_text fingerprint edited next n_docs term quoted place
by_quote node root crowd family gram grams at text_hash cell copies shown none id n_shingles component_id score offending label __s __key
__lot __range __start __k __at __c one base_failed distance judged_by kept sequence_id offset start_ length sid piece""".split()


@pytest.fixture(scope="module")
def clashing(spark, awkward):
    """Awkward rows with further columns that have the names operators work with, each of one value."""
    more = [F.lit(f"own {c}").alias(c) for c in INNER]
    base = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    df = base.select("*", *more, F.lit("turn").alias("Turn"))
    nulls = spark.createDataFrame([(None,) * 5], base.schema).select("*", *[F.lit(None).cast("string").alias(c) for c in df.columns[5:]])
    return df.union(nulls)


def own_values(df):
    """The columns with names that clash whose values aren't what they were."""
    names = [c for c in INNER if c in df.columns]
    rows = df.where("doc_id is not null").select(*[F.col(c).cast("string") for c in names]).distinct().collect()
    return [c for c in names if any(r[c] != f"own {c}" for r in rows)]


def test_operators_with_clashing_names(clashing, labels):
    learn, n = F.coalesce(crc_mod(F.col("doc_id"), 4) != 2, F.lit(False)), clashing.count()
    added = {
        "classify": (quality_classifier.classify(clashing, labels, learn), ["score"]),
        "judge": (quality_rules.judge(clashing), [*quality_rules.COUNTS, "base_failed", "distance", "judged_by", "kept"]),
        "mix": (mixing.mix(mixing.sized(clashing)), ["size", "source_size", "target", "taken", "position", "takes"]),
        "fingerprints": (imatch.fingerprints(clashing), list(imatch.MADE)),
        "detect": (toxicity.detect(clashing, labels, learn), ["score", "offending"]),
    }
    for name, (df, made) in added.items():
        assert df.count() == n, name
        assert not set(own_values(df)) - set(made), name
        assert {c for c in clashing.columns if c != "text"} <= set(df.columns), name
    assert jaccard_join.group(clashing).count() == n
    assert len(packing.pack_documents(clashing, byte_bpe()).select("doc_id").distinct().collect()) == clashing.select("doc_id").distinct().count()
    assert sharding.assign(clashing).count() == n


def test_pipeline_stages_with_awkward_tables(spark, clashing, empty):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES:
        for df in (clashing, empty.select("doc_id", "text", "lang", "source", "n_chars")):
            out = stage(spark, df, SF)
            rows = out.count()
            if stage is not corpus_pipeline.pack_sequences:
                assert out.columns == df.columns, name
                assert own_values(out) == [], name
            assert rows > 0 if df is clashing else rows == 0, name


def test_pipeline_stages(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
    assert len(pipeline.STAGES) == 5
    rows = pipeline.run(spark, SF).collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}
