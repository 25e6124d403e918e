"""Document fingerprints by I-Match over randomised lexicon subsets.

The lexicon holds the terms whose share of documents lies in a band: too common ones say little, rare ones are typos and
names. Its randomised subsets overlap: at each of ``levels`` a term is kept with a chance that falls by ``spread`` from
one level to the next, and what is kept is dealt into ``parts`` random parts. For each part of each level, a document's
distinct terms in it are sorted and hashed; the fingerprint is the row of these hashes. A part holds one or two terms of
a document at the level that suits its length, so the likeness of two fingerprints, the share of equal hashes among the
parts that either has terms of, is taken over the levels of which at most half of the parts are held. A text without a
term of the band has one hash of all its terms, or of itself if it has none, and is only like its equals.

The lexicon is bounded: a document share of at least ``low`` leaves at most (mean distinct terms of a document) / low
terms, whatever the corpus; it becomes a hash table in the expression, a few lookups a term. Counts are over all documents.

Neighbours: documents are parted into ranges of the id whose bounds occur; the first of each range is also sent to the
range before, so every document meets its successor in one shuffle, no task having more than a range.

Nulls: a null text is empty; null ids come last and are neighbours in the order of their texts' hashes, as are rows with
equal ids. An empty table gives an empty result. Columns of the names added are replaced; others may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import _longs, let, need, range_bounds, range_of
from .text_stats import fields

#: What parts terms: ASCII but letters and digits.
BETWEEN = r"[\x00-\x2F:-@\[-`{-\x7F]+"
#: The hash of a part of which a text has no term.
NONE = ""
MADE = ("n_chars", "fingerprint", "edited_sha256", "edited", "next")


@dataclass(frozen=True)
class Lexicon:
    """Band of the share of documents, and the randomised subsets; at least ``least`` documents show a term."""

    low: float = 0.001
    high: float = 0.2
    least: int = 2
    levels: int = 4
    spread: int = 4
    parts: int = 32
    rows_per_range: int = 2048
    most_ranges: int = 32_768


def terms(text: Column) -> Column:
    """Distinct terms of a text as 64-bit hashes."""
    words = F.array_remove(F.split(F.lower(text), BETWEEN), "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, band: Lexicon = Lexicon(), text: str = "text") -> DataFrame:
    """(term, n_docs) for the terms of the band, counted over all ``docs``."""
    n = docs.count()
    counts = docs.select(F.explode(terms(F.coalesce(F.col(text), F.lit("")))).alias("term")).groupBy("term")
    shown = counts.agg(F.count(F.lit(1)).alias("n_docs"))
    return shown.where((F.col("n_docs") >= max(band.least, band.low * n)) & (F.col("n_docs") <= max(band.least, band.high * n)))


def _table(words: DataFrame) -> tuple[list[int], int]:
    """Open addressing of the bounded lexicon: a list in which a term lies at most ``reach`` places after its own."""
    known = [r["term"] for r in words.select("term").collect()]
    slots = 1 << max(6, (2 * len(known)).bit_length())
    while True:
        table, reach = [0] * (slots + 64), 1
        for term in sorted(known):
            at = term % slots
            while table[at] and at - term % slots < 63:
                at += 1
            reach = max(reach, at - term % slots + 1)
            table[at] = term
        if reach <= 8:
            return table, reach
        slots *= 2


def fingerprint(text: Column, table: tuple[list[int], int], band: Lexicon) -> Column:
    """Array of the hashes, eight hex digits each, of the sorted distinct terms in each part of each level, and one more
    of a text without any."""

    entries, reach = table
    slots = len(entries) - 64
    bits = (band.parts - 1).bit_length()
    room = 61 - band.parts.bit_length()  # bits of a term beside its part
    marks = [i << room for i in range(band.parts + 1)]

    def digits(x: Column) -> Column:
        return F.lower(F.lpad(F.hex(F.pmod(x, F.lit(1 << 32))), 8, "0"))

    def held(words: Column, all_: Column) -> Column:
        def known(t: Column) -> Column:
            at = F.pmod(t, F.lit(slots)).cast("int")
            found = F.lit(False)
            for i in reversed(range(reach)):
                here = F.get(words, at + i)
                found = F.when(here == t, F.lit(True)).when(here == 0, F.lit(False)).otherwise(found)
            return found

        return F.filter(all_, known)

    lot = lambda t: F.xxhash64(t, F.lit(1))

    def level(kept: Column, j: int) -> Column:
        """The hashes of the parts of a level; ``kept`` are the terms of the level before."""
        part = lambda t: F.shiftrightunsigned(lot(t), 64 - bits)
        codes = F.transform(kept, lambda t: F.shiftleft(part(t), room) + F.shiftrightunsigned(t, 65 - room))
        own = let(F.sort_array(F.concat(codes, _longs(marks))), hashes)
        if j == band.levels - 1:
            return own
        some = F.filter(kept, lambda t: F.pmod(lot(t), F.lit(band.spread ** (j + 1))) == 0)
        return F.concat(own, let(some, lambda s: level(s, j + 1)))

    def hashes(sorted_: Column) -> Column:
        where = [F.array_position(sorted_, F.lit(m)).cast("int") for m in marks]

        def piece(i: int, at: Column) -> Column:
            first, end = F.get(at, F.lit(i)), F.get(at, F.lit(i + 1))
            value = digits(F.xxhash64(F.slice(sorted_, first + 1, end - first - 1)))
            return F.when(end - first <= 1, F.lit(NONE)).otherwise(value)

        return let(F.array(*where), lambda at: F.array(*[piece(i, at) for i in range(len(marks) - 1)]))

    def whole(all_: Column, kept: Column) -> Column:
        own = F.when(F.size(all_) > 0, F.xxhash64(F.sort_array(all_))).otherwise(F.xxhash64(text))
        rest = F.when(F.size(kept) > 0, F.lit(NONE)).otherwise(digits(own))
        return F.concat(level(kept, 0), F.array(rest))

    return let(terms(text), lambda all_: let(let(_longs(entries), lambda w: held(w, all_)), lambda kept: whole(all_, kept)))


def likeness(a: Column, b: Column, band: Lexicon = Lexicon()) -> Column:
    """Share of equal hashes among the parts that either fingerprint (arrays) has terms of, over the levels of which either
    has at most half, and the last; equal ones are 1."""

    def level(j: int) -> Column:
        x, y = (F.slice(c, band.parts * j + 1, band.parts) for c in (a, b))
        each = F.zip_with(x, y, lambda p, q: F.when((p == NONE) & (q == NONE), 0).when(p == q, 2).otherwise(1))

        def counts(c: Column) -> Column:
            some = F.size(F.filter(c, lambda v: v > 0))
            fits = (some * 2 <= band.parts) | F.lit(j == band.levels - 1)
            equal = F.size(F.filter(c, lambda v: v == 2))
            return F.struct(F.when(fits, some).otherwise(0).alias("some"), F.when(fits, equal).otherwise(0).alias("equal"))

        return let(each, counts)

    def share(levels: Column) -> Column:
        total = lambda name: sum((F.get(levels, F.lit(j))[name] for j in range(band.levels)), F.lit(0))
        return F.when(total("some") == 0, F.lit(0.0)).otherwise(total("equal") / total("some").cast("double"))

    return F.when(a == b, F.lit(1.0)).otherwise(let(F.array(*[level(j) for j in range(band.levels)]), share))


def with_successor(df: DataFrame, key: str, columns: list[str], band: Lexicon, ties: list[Column]) -> DataFrame:
    """``df`` with next_<c> for each of ``columns``: its value in the next row by the long ``key``, the first after the last."""
    order = F.coalesce(F.col(key), F.lit((1 << 63) - 1))
    df = df.withColumn("__k", order)
    bounds = range_bounds(df, "__k", min(band.most_ranges, -(-df.count() // band.rows_per_range)))
    at = range_of(F.col("__k"), bounds)
    first = F.get(_longs(bounds), F.col("__r")) == F.col("__k")
    home = F.struct(F.col("__r").alias("r"), F.lit(0).alias("wrap"), F.lit(False).alias("ghost"))
    wraps = F.col("__r") == 0
    before = F.struct(
        F.when(wraps, F.lit(max(0, len(bounds) - 1))).otherwise(F.col("__r") - 1).alias("r"),
        wraps.cast("int").alias("wrap"),
        F.lit(True).alias("ghost"),
    )
    sent = F.when(first, F.array(home, before)).otherwise(F.array(home))
    rows = df.withColumn("__r", at).select("*", F.explode(sent).alias("__at")).drop("__r")
    w = Window.partitionBy("__at.r").orderBy("__at.wrap", "__k", *ties)
    rows = rows.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
    return rows.where("not __at.ghost").drop("__at", "__k")


def fingerprints(docs: DataFrame, band: Lexicon = Lexicon(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_chars, fingerprint (array), and of the edited text: edited_sha256, edited (array); and next (array).

    The edited text is the document with its last half replaced by the first half as long of its successor.
    """
    need(docs, key, text)
    table = _table(lexicon(docs, band, text))
    kept = F.struct(*[c for c in docs.columns if c not in (text, *MADE)]).alias("__doc")
    df = docs.select(kept, F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    df = df.withColumn("n_chars", F.char_length("text").cast("long"))
    df = df.withColumn("fingerprint", fingerprint(F.col("text"), table, band)).withColumn("h", F.xxhash64("text"))
    df = with_successor(df, "key", ["text", "fingerprint"], band, [F.col("n_chars"), F.col("h")])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")),
        F.substring(F.col("next_text"), F.lit(1), half),
    )
    df = df.withColumn("edited_text", edited)
    return df.select(
        *fields(df, "__doc"),
        F.col("text").alias(text),
        "n_chars",
        "fingerprint",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("edited_text"), table, band).alias("edited"),
        F.col("next_fingerprint").alias("next"),
    )
