"""Secrets in texts: fixed patterns, and strings in sensitive places that compression can't tell from noise.

Patterns (``KINDS``) give base spans: leftmost matches of each kind that don't overlap, of which those too short are
dropped. The method adds ``novel`` spans: a candidate is a string of at least ``least_chars`` letters, digits and marks
that begins within ``reach`` characters after a sensitive word (``SENSITIVE``), mixes kinds of characters as keys do,
and lies outside the base spans. Its novelty is the number of bytes that it adds, for each of its own, when Zstandard
compresses it behind the code around it, primed with a dictionary of identifiers; the median over windows of three
widths counts. Names and words repeat what surrounds them or the dictionary, or share its letters, and cost half a byte
or so a character; keys cost one. Candidates of at least ``least_novelty`` are reported, if they and what surrounds them
in lower case come to ``least_folded`` too: a name that is new only in its capitals is none.

The dictionary holds the words that stand around sensitive words in most documents, counted over all documents; its
size is bounded (``dictionary_words``, each of at most 64 characters), so it is small whatever the corpus. Everything else
happens within the partitions of the input: no shuffle of texts, no hot task.

Positions are code points, ends exclusive. Nulls: a null text is empty and has no spans. Null or repeated keys are kept,
each row is a document. An empty table gives an empty result; without sensitive words the dictionary is empty. Columns
of the name added are replaced; others may have any names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import median

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import need

#: Kind, pattern, the group whose length counts, and its least length.
KINDS = [
    ("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, re.I | re.A),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, re.A),
    ("hex", r"[0-9a-f]{24,}", 0, 24, re.A),  # runs are maximal, so shorter ones may be left out here
]
_COMPILED = [(kind, re.compile(pattern, flags), group, least) for kind, pattern, group, least, flags in KINDS]
NOVEL = "novel"
#: Words after which strings may be secrets, in either case.
SENSITIVE = (
    r"passw|passphrase|\bpwd|secret|token|credential|bearer|signature|webhook|cookie"
    r"|(?:api|private|access|signing|encryption)[_ -]?key|auth(?:orization|entication|[_-])|(?:client|session)[_-]?id"
)
_SENSITIVE = re.compile(f"(?:{SENSITIVE})", re.I | re.A)
#: A text without any of these, in lower case, has no sensitive word.
_SIGNS = [x.encode() for x in "passw passphrase pwd secret token credential bearer signature webhook cookie key auth client session".split()]
_HEX = re.compile(rb"[0-9a-f]{24}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/][A-Za-z0-9+/_.=~-]*")
_WORD = re.compile(r"[^\W\d_]{2,64}")
_LEVEL = 3
_LOWER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Novelty:
    reach: int = 64
    least_chars: int = 12
    least_novelty: float = 0.8
    least_folded: float = 0.65
    windows: tuple[int, ...] = (200, 500, 1000)
    dictionary_words: int = 4096
    around: int = 256


def _signed(raw: bytes) -> bool:
    low = raw.lower()
    return any(sign in low for sign in _SIGNS)


def base_spans(raw: bytes, text: str, sensitive: bool) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches, kind by kind."""
    may = {"assign": sensitive, "access": b"AKIA" in raw, "hex": _HEX.search(raw) is not None}
    found = []
    for kind, pattern, group, least in _COMPILED:
        if may[kind]:
            found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return found


def mixes(x: str) -> bool:
    """Whether letters come with digits or in both cases, a capital at the head of a word apart."""
    letters = sum(c.isalpha() for c in x)
    inner = re.sub(r"\b[A-Z](?=[a-z])", "a", x)
    kinds = any(c.isdigit() for c in x) + any(c.islower() for c in inner) + any(c.isupper() for c in inner)
    return letters >= 4 and kinds >= 2


def candidates(text: str, base: list[tuple[str, int, int]], novelty: Novelty) -> list[tuple[int, int]]:
    """Ascending spans of strings in sensitive places outside the base spans."""
    found, done = [], 0
    taken = sorted((s, e) for _, s, e in base)
    for word in _SENSITIVE.finditer(text):
        at = max(word.end(), done)
        while (m := _CANDIDATE.search(text, at)) and m.start() <= word.end() + novelty.reach:
            at = done = m.end()
            end = m.start() + len(m.group().rstrip(".=~-"))
            end += len(re.match("=*", text[end : m.end()]).group())
            if end - m.start() < novelty.least_chars or not mixes(text[m.start() : end]):
                continue
            if not any(s < end and m.start() < e for s, e in taken):
                found.append((m.start(), end))
    return found


def _folded(text: str) -> str:
    """The text with A-Z in lower case, each character in its place."""
    return text.translate(_LOWER)


def disjoint(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in ascending order, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def blanked(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with blanks in place of ascending spans."""
    out, at = [], 0
    for start, end in spans:
        out += [text[at:start], " " * (end - start)]
        at = end
    return "".join([*out, text[at:]])


class Measure:
    """Marginal compressed bytes of a string behind its surroundings and the words of the dictionary."""

    def __init__(self, words: list[str], novelty: Novelty):
        import zstandard

        self.windows = novelty.windows
        blob = _folded("\n".join(words)).encode()
        self.head = blob[-1024:] + b"\n"
        options = {"level": _LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        if len(blob) >= 8:
            primed = zstandard.ZstdCompressionDict(blob, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(level=_LEVEL)
            options["dict_data"] = primed
        self._press = zstandard.ZstdCompressor(**options).compress

    def __call__(self, around: str, start: int, end: int, own: bytes) -> float:
        """Bytes for each of ``own``, which lies from ``start`` to ``end`` in the text ``around`` it."""
        rates = []
        for width in self.windows:
            near = around[max(0, start - width) : start] + "\n" + around[end : end + width]
            before = self.head + near.encode() + b"\n"
            rates.append((len(self._press(before + own)) - len(self._press(before))) / len(own))
        return median(rates)


def identifiers(docs: DataFrame, text: str = "text", novelty: Novelty = Novelty()) -> list[str]:
    """The words found around sensitive words in most documents, the most widespread last; at most ``dictionary_words``.

    What lies in candidates or base spans takes no part, or keys would be in the dictionary that is to tell them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[str] = []
            for x in batch.column(0):
                raw = x.as_py() or b""
                if _signed(raw):
                    whole, around = raw.decode("utf-8", "replace"), novelty.around
                    base = base_spans(raw, whole, True)
                    whole = blanked(whole, disjoint([*candidates(whole, base, novelty), *((s, e) for _, s, e in base)]))
                    words, done = set(), 0
                    for m in _SENSITIVE.finditer(whole):
                        words.update(_WORD.findall(whole, max(done, m.start() - around), m.end() + around))
                        done = m.end() + around
                    out += words
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["word"])

    counts = docs.select(F.col(text).cast("binary")).mapInArrow(run, "word string").groupBy("word").count()
    rows = counts.orderBy(F.desc("count"), "word").limit(novelty.dictionary_words).collect()  # bounded by the parameter
    return [r["word"] for r in rows][::-1]


def scan(docs: DataFrame, text: str = "text", novelty: Novelty = Novelty()) -> DataFrame:
    """``docs`` without ``text``, with spans: (kind, start, end, novelty) by start and then kind, as listed, novel last.

    novelty is null for base spans.
    """
    need(docs, text)
    docs = docs.select(*[c for c in docs.columns if c != "spans"])
    words = identifiers(docs, text, novelty)
    keep = [c for c in docs.columns if c != text]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    made = "spans array<struct<kind: string, start: long, end: long, novelty: double>>"
    order = {kind: i for i, kind in enumerate([*(k[0] for k in KINDS), NOVEL])}
    one = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.float64())])

    def spans(raw: bytes, measure: Measure) -> list[dict]:
        sensitive = _signed(raw)
        if not (sensitive or b"AKIA" in raw or _HEX.search(raw)):
            return []
        whole = raw.decode("utf-8", "replace")
        base = base_spans(raw, whole, sensitive)
        found = [(*b, None) for b in base]
        some = candidates(whole, base, novelty) if sensitive else []
        around = blanked(whole, some)  # what repeats in other sensitive places is no identifier
        folded = _folded(around) if some else ""
        for s, e in some:
            own = whole[s:e]
            rate = measure(around, s, e, own.encode())
            if rate >= novelty.least_novelty and measure(folded, s, e, _folded(own).encode()) >= novelty.least_folded:
                found.append((NOVEL, s, e, rate))
        found.sort(key=lambda f: (f[1], order[f[0]]))
        return [dict(zip(("kind", "start", "end", "novelty"), f, strict=True)) for f in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Measure(words, novelty)
        for batch in batches:
            found = [spans(x.as_py() or b"", measure) for x in batch.column(0)]
            rest = [batch.column(i) for i in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(found, pa.list_(one))], [*keep, "spans"])

    return docs.select(F.col(text).cast("binary"), *keep).mapInArrow(run, f"{kinds}, {made}" if kinds else made)
