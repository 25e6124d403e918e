"""Counts of a whole text as native column expressions: no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let

#: Characters that the base rules call symbols.
SYMBOLS = r"[#*$%&|<>]"
#: Words of a window whose repetition counts.
WINDOW = 5


def words_of(text: Column) -> Column:
    """The words of a text in order; none for an empty one."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def _covered(starts: Column) -> Column:
    """Words under the windows that begin at the ascending ``starts``."""
    return F.aggregate(
        starts,
        F.struct(_long(0).alias("n"), _long(-WINDOW).alias("last")),
        lambda acc, at: F.struct((acc["n"] + F.least(_long(WINDOW), at - acc["last"])).alias("n"), at.alias("last")),
        lambda acc: acc["n"],
    )


def _repeated(windows: Column) -> Column:
    """Ascending starts of the windows whose hash occurs twice or more.

    Hash and start are sorted as one long: the hash rounded down to a multiple of the number of windows, plus the start.
    """
    n = F.size(windows).cast("long")
    codes = F.sort_array(F.transform(windows, lambda h, i: F.shiftright(h, 1) - F.pmod(F.shiftright(h, 1), n) + i))
    start = lambda code: F.pmod(code, n)
    at = lambda code: F.get(windows, start(code).cast("int"))

    def same(s: Column, x: Column, j: Column) -> Column:
        near = lambda y: F.coalesce((F.abs(y - x) < n) & (at(y) == at(x)), F.lit(False))
        return near(F.get(s, j - 1)) | near(F.get(s, j + 1))

    return let(codes, lambda s: F.sort_array(F.transform(F.filter(s, lambda x, j: same(s, x, j)), start)))


def repeat_words(hashes: Column) -> Column:
    """Words that lie in a window of five words found twice or more in the text (windows are held as 64-bit hashes)."""

    def windows(h: Column) -> Column:
        each = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]))
        return F.slice(each, F.lit(1), F.size(h) - (WINDOW - 1))

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), _long(0)).otherwise(_covered(_repeated(w)))

    return F.when(F.size(hashes) <= WINDOW, _long(0)).otherwise(let(windows(hashes), count))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def base_statistics(text: Column) -> Column:
    """A struct of long counts of a text (null: empty): what the base rules of quality need."""
    whole = F.coalesce(text, F.lit(""))

    def of(words: Column, hashes: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.concat_ws("", words)).cast("long").alias("word_chars"),
            _count(whole, SYMBOLS).alias("n_symbols"),
            duplicate_lines(whole).alias("n_dup_lines"),
            repeat_words(hashes).alias("n_repeat_words"),
            F.size(F.array_distinct(hashes)).cast("long").alias("n_distinct_words"),
        )

    return let(words_of(whole), lambda w: let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: of(w, h)))


def style_statistics(text: Column) -> Column:
    """A struct of long counts of a text (null: empty) that tell fluent prose from noise."""
    whole = F.coalesce(text, F.lit(""))

    def of(words: Column, hashes: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.concat_ws("", words)).cast("long").alias("word_chars"),
            _count(whole, SYMBOLS).alias("n_symbols"),
            _count(whole, r"[A-ZÀ-Þ]").alias("n_upper"),
            _count(whole, r"[!?.,;:]").alias("n_marks"),
            _count(whole, r"[0-9@/=_{}\[\]\\^~+]").alias("n_codes"),
            F.size(F.array_distinct(hashes)).cast("long").alias("n_distinct_words"),
            F.size(F.filter(hashes, lambda x, i: x == F.get(hashes, i + 1))).cast("long").alias("n_echo_words"),
            duplicate_lines(whole).alias("n_dup_lines"),
        )

    return let(words_of(whole), lambda w: let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: of(w, h)))


def with_statistics(docs: DataFrame, kind, text: str = "text") -> DataFrame:
    """``docs``, as the struct __doc, and the counts of ``kind`` as the struct __s: names of columns can't clash."""
    return docs.select(F.struct(*docs.columns).alias("__doc"), kind(F.col(text)).alias("__s"))


def fields(df: DataFrame, struct: str, *without: str) -> list[Column]:
    """The fields of a struct column as columns, but for ``without``."""
    return [F.col(struct)[f.name].alias(f.name) for f in df.schema[struct].dataType.fields if f.name not in without]
