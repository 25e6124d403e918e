"""Mixing sources to target weights along a time-varying curriculum.

Sources rank by code point, null last, and take weights and ramps in turn. A source's words in the mix (its target) are
its weight's share of all words, at most ``most`` times its own; the excess goes to the others by weight, until none is
above. Over training time t from 0 to 1 its weight is ``target * (1 + ramp * (2 t - 1))``; the integral, the cumulative
demand ``target * ((1 - ramp) t + ramp t^2)``, is inverted for each document: documents supply words in the order of a
hash of their ids, again for every repetition, and train when demand reaches the middle of what they supply. Documents
are taken whole or not at all: those whose middle lies within the words wanted, so that a source misses its target by at
most half a document, the nearer of its last two choices.

The order within a source is cut into ranges of the hash whose sums are ranged first, so a hot source is no hot task.

Nulls: a null text has no words; null sources are one source; null ids rank first. Equal ids tie by size; rows that are
equal in both are interchangeable. Documents without words are never taken (position null). An empty table gives an
empty result. Columns of the names added are replaced; others may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import need, running_before, written
from .text_stats import fields, words_of


@dataclass(frozen=True)
class Curriculum:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    ramps: tuple[float, ...] = (-0.5, 0.0, 0.5)
    most: int = 3
    rows_per_range: int = 8192


def _in_turn(values: tuple[float, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), ((F.col("rank") - 1) % len(values) + 1).cast("int"))


def targets(sources: DataFrame, curriculum: Curriculum) -> DataFrame:
    """``sources`` (source, source_size) with rank, weight, ramp and target: one window over a row for each source."""
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    df = ranked.select(
        "*",
        _in_turn(curriculum.weights).alias("weight"),
        _in_turn(curriculum.ramps).alias("ramp"),
        (F.lit(float(curriculum.most)) * F.col("source_size")).alias("most"),
    )
    order = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    df = df.select(
        "*",
        F.sum("source_size").over(everything).cast("double").alias("all_words"),
        F.sum("weight").over(everything).alias("all_weight"),
        F.coalesce(F.sum("most").over(before), F.lit(0.0)).alias("most_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weight_before"),
    )
    left_words, left_weight = F.col("all_words") - F.col("most_before"), F.col("all_weight") - F.col("weight_before")
    df = df.withColumn("full", F.col("most") * left_weight <= F.col("weight") * left_words)
    df = df.select(
        "*",
        F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0.0)).alias("full_words"),
        F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))).over(everything), F.lit(0.0)).alias("full_weight"),
    )
    shared = F.col("weight") * (F.col("all_words") - F.col("full_words")) / (F.col("all_weight") - F.col("full_weight"))
    target = F.when(F.col("full"), F.col("most")).otherwise(shared)
    return df.select(*sources.columns, "rank", "weight", "ramp", target.alias("target"))


def demand_time(share: Column, ramp: Column) -> Column:
    """The time at which the cumulative demand ``(1 - ramp) t + ramp t^2`` reaches ``share``."""
    root = F.sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * share)
    return F.when(ramp == 0, share).otherwise((root - (1 - ramp)) / (2 * F.when(ramp == 0, F.lit(1.0)).otherwise(ramp)))


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with size: the words of the whole text."""
    need(docs, "doc_id", "source", text)
    words = F.size(words_of(F.coalesce(F.col(text), F.lit("")))).cast("long")
    return docs.withColumn("size", words)


def mix(docs: DataFrame, curriculum: Curriculum = Curriculum()) -> DataFrame:
    """``docs`` (doc_id, source, size and any others) with source_size, target, taken, position, and takes.

    takes: an array of (epoch, words, position), a struct for each time that the document is taken; taken is the sum of
    its words and position, from 0 to 1, the first of its positions.
    """
    rows = _placed(docs, curriculum)
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda n, x: n + x["words"])
    first = F.array_min(F.transform("takes", lambda x: x["position"]))
    kept = fields(rows, "__doc", "source_size", "target", "taken", "position", "takes")
    return rows.select(*kept, "source_size", "target", taken.alias("taken"), first.alias("position"), "takes")


def _placed(docs: DataFrame, curriculum: Curriculum) -> DataFrame:
    """``docs`` as the struct __doc, with source_size, target and takes."""
    need(docs, "doc_id", "source", "size")
    sources = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("__key")
    plan = written(
        targets(sources, curriculum).select(
            key, "source_size", "ramp", "target", F.ceil(F.col("n") / curriculum.rows_per_range).alias("ranges")
        )
    )
    lot = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    df = docs.select(F.struct(*docs.columns).alias("__doc"), "doc_id", "size", key, lot.alias("__lot")).join(plan, "__key")
    where = F.conv(F.substring("__lot", 1, 8), 16, 10).cast("long") * F.col("ranges")
    df = df.withColumn("__range", F.shiftright(where, 32))
    df = running_before(df, ["__key"], "__range", [F.col("__lot"), F.col("doc_id"), F.col("size")], "size", "__start")
    want = F.floor(F.col("target") + 0.5)

    def take(epoch: Column) -> Column:
        start = F.col("source_size") * epoch + F.col("__start")
        words = F.when(2 * start + F.col("size") <= 2 * want, F.col("size")).otherwise(F.lit(0).cast("long"))
        share = (start + words / F.lit(2.0)) / F.greatest(want, F.lit(1).cast("long"))
        at = demand_time(F.least(share, F.lit(1.0)), F.col("ramp"))
        return F.struct(epoch.alias("epoch"), words.alias("words"), at.alias("position"))

    takes = F.array(*[take(F.lit(e).cast("long")) for e in range(curriculum.most)])
    return df.select("__doc", "source_size", "target", F.filter(takes, lambda x: x["words"] > 0).alias("takes"))


def training_order(docs: DataFrame, curriculum: Curriculum = Curriculum(), text: str = "text") -> DataFrame:
    """``docs`` (doc_id, source, text and any others), an unchanged row for each take, range-sorted by position."""
    need(docs, "doc_id", "source", text)
    whole = docs.select(F.struct(*docs.columns).alias("__whole"), "doc_id", "source", F.col(text).alias("text"))
    rows = _placed(sized(whole, "text").drop("text"), curriculum).select("__doc.__whole", F.explode("takes").alias("take"))
    ordered = rows.orderBy("take.position", "__whole.source", "__whole.doc_id", "take.epoch")
    return ordered.select(*fields(ordered, "__whole"))


#: The same in DuckDB's SQL.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS weight,
    CASE (rank - 1) % 3 WHEN 0 THEN -5e-1 WHEN 1 THEN 0e0 ELSE 5e-1 END AS ramp,
    3e0 * source_size AS most
  FROM ranked
), summed AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS all_words, sum(weight) OVER () AS all_weight,
    coalesce(sum(most) OVER o, 0e0) AS most_before, coalesce(sum(weight) OVER o, 0e0) AS weight_before
  FROM weighted
  WINDOW o AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), filled AS (
  SELECT *, most * (all_weight - weight_before) <= weight * (all_words - most_before) AS is_full FROM summed
), planned AS (
  SELECT source, source_size, ramp, CASE WHEN is_full THEN most ELSE
    weight * (all_words - coalesce(sum(CASE WHEN is_full THEN most END) OVER (), 0e0))
    / (all_weight - coalesce(sum(CASE WHEN is_full THEN weight END) OVER (), 0e0)) END AS target
  FROM filled
), placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.ramp, CAST(floor(p.target + 5e-1) AS BIGINT) AS want,
    CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(CAST(s.doc_id AS VARCHAR), '')),
      s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
), takes AS (
  SELECT *, CASE WHEN 2 * start + size <= 2 * want THEN size ELSE 0 END AS w0,
    CASE WHEN 2 * (start + source_size) + size <= 2 * want THEN size ELSE 0 END AS w1,
    CASE WHEN 2 * (start + 2 * source_size) + size <= 2 * want THEN size ELSE 0 END AS w2
  FROM placed
), shares AS (
  SELECT *, least(1e0, (start + w0 / 2e0) / greatest(want, 1)) AS share FROM takes
)
SELECT doc_id, size, source_size, target, CAST(w0 + w1 + w2 AS BIGINT) AS taken,
  CASE WHEN w0 = 0 THEN NULL WHEN ramp = 0 THEN share
    ELSE (sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * share) - (1 - ramp)) / (2 * ramp) END AS position
FROM shares
"""
