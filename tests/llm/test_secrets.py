"""Secret scans: base spans against the patterns by hand, planted strings, and words that are none."""

import base64
import hashlib
import random
import re
import string

from pyspark.sql import functions as F

from thalweg.llm import queries, secrets

SF = "/root/testdata/sf0.001"
LETTERS = re.compile(r"[A-Za-z0-9+/_.=-]")


def keyword(text, at):
    for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
        part = text[at : at + len(word)]
        if len(part) == len(word) and all(a == b or (b.isalpha() and a.isascii() and a.lower() == b) for a, b in zip(part, word)):
            return len(word)
    return 0


def assignments(text):
    """The first pattern, by hand: a word, a quote, blanks, a sign, blanks, a quote, and a value."""
    out, i = [], 0
    while i < len(text):
        n = keyword(text, i)
        j = i + n
        if n:
            j += text[j : j + 1] in ('"', "'") and text[j : j + 1] != ""
            while text[j : j + 1] == " ":
                j += 1
            if text[j : j + 1] in (":", "=") and text[j : j + 1]:
                j += 1
                while text[j : j + 1] == " ":
                    j += 1
                j += text[j : j + 1] in ('"', "'") and text[j : j + 1] != ""
                k = j
                while k < len(text) and LETTERS.match(text[k]):
                    k += 1
                if k > j:
                    if k - j >= 6:
                        out.append(("assign", i, k))
                    i = k
                    continue
        i += 1
    return out


def brute_base(text):
    found = assignments(text)
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return sorted(found, key=lambda f: (f[1], ["assign", "access", "hex"].index(f[0])))


def test_query_by_brute_force(spark):
    got = {r.doc_id: r for r in queries.op12_zstd_secrets(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        want, row = brute_base(r.text or ""), got[r.doc_id]
        assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(w[0] == k for w in want) for k in ("assign", "access", "hex"))
        listed = row.spans.split(",") if row.spans else []
        assert [x for x in listed if not x.startswith("novel")] == [f"{k}:{s}:{e}" for k, s, e in want]
        assert len(listed) == len(want) + row.n_novel


def test_base_spans_of_awkward_texts():
    hexes = "0123456789abcdef" * 2
    texts = [
        "", "PassWord = 'hunter22' é token:abc secret=token: abcdefgh", "ſecret=abcdefgh toKen=abcdefgh api key=abcdefgh API_KEY:'x.y=z-1'",
        f"é漢 AKIA{'B' * 16} AKIAB {hexes} token={hexes} {hexes[:23]}", "secret\x20\x20\x20=\x20" + "A" * 99, "token\t=abcdefgh", "AKIAAKIA" + "Z9" * 9,
    ]
    for t in texts:
        found = secrets.base_spans(t.encode(), t, secrets._signed(t.encode()))
        assert sorted(found) == sorted(brute_base(t)), t


def noise(rng, n, letters=string.ascii_letters + string.digits):
    return "".join(rng.choice(letters) for _ in range(n))


def test_planted_strings_are_found_and_names_left_alone(spark):
    rng = random.Random(3)
    stems = "river basin lake stream gauge order link cell tile flow path ring area slope".split()
    name = lambda: "_".join(rng.sample(stems, 3))
    rows, keys = [], {}
    for i in range(300):
        lines = [f"def {name()}({name()}, {name()}):\n    return {name()} + {rng.randint(1, 99)}" for _ in range(12)]
        at = rng.randrange(12)
        if i % 3 == 0:
            key = noise(rng, rng.randint(24, 40))
            lines[at] = rng.choice(['headers = {"Authorization": "Bearer %s"}', "credential is '%s'", "private key -> %s", "cookie <%s>"]) % key
            keys[i] = key
        elif i % 3 == 1:
            lines[at] = f"credential from {name()}{rng.randint(1, 9)} or Authorization of {name().title()}2"
        else:
            lines[at] = f"{name()} {noise(rng, 30)}"  # noise, but in no sensitive place
        rows.append((i, "\n".join(lines)))
    got = {r.doc_id: r.spans for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    hit = [i for i in keys if any(texts[i][s.start : s.end] == keys[i] and s.kind == "novel" for s in got[i])]
    assert len(hit) >= 0.97 * len(keys)
    assert sum(len(got[i]) > 0 for i in texts if i not in keys) <= 4
    assert all(s.novelty >= 0.8 for x in got.values() for s in x)


def test_awkward_rows(spark):
    rng = random.Random(1)
    long = "plain words of a long text. " * 20_000 + f"bearer {noise(rng, 40)} end"
    rows = [(1, None, "own"), (2, "", "own"), (None, "token=abcdef", "own"), (4, "token=abcdef", "own"), (4, "token=abcdef", "own"), (5, long, None), (6, "bearer " + base64.b64encode(bytes(range(40))).decode() + "\n" * 3, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string").withColumn("kind", F.lit("own"))
    got = secrets.scan(df)
    assert got.columns == ["doc_id", "kind", "spans"]
    out = got.collect()
    assert len(out) == len(rows) and {r.kind for r in out} == {"own"}
    assert sorted((str(r.doc_id), [s.kind for s in r.spans]) for r in out) == [("1", []), ("2", []), ("4", ["assign"]), ("4", ["assign"]), ("5", ["novel"]), ("6", ["novel"]), ("None", ["assign"])]
    assert secrets.scan(df.where("false")).count() == 0
    assert secrets.scan(df.select("text")).columns == ["spans"]
