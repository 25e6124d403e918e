"""Quotation linking on a table with quotations, against the SQL of its query."""

import duckdb
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thalweg.llm import quotations
from thalweg.llm.common import written
from thalweg.llm.quotations import placed

SF = "/root/testdata/sf0.001"


def quoting(messages: DataFrame) -> DataFrame:
    """``messages`` in which four in five messages, by a hash of conversation and place, also quote: the message before,
    that one and within it the one before it, only the latter, or the opening of their own conversation with that of the
    conversation numbered one less within it. For tables of plain turns, so that there are quotations to link."""
    df = placed(messages.select("conv_id", "turn", "role", "text"))
    at = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.col("place"))
    kind = F.conv(F.substring(F.md5(at.cast("binary")), 1, 8), 16, 10).cast("long") % 5
    df = written(df.withColumn("kind", kind))
    back = lambda n, name: df.select("__c", (F.col("place") + n).alias("place"), F.col("text").alias(name))
    opening = df.where("place = 0").select("__c", "conv_id", F.col("text").alias("opening"))
    other = opening.where("conv_id is not null").select((F.col("conv_id") + 1).alias("conv_id"), F.col("opening").alias("other"))
    df = df.join(back(1, "one"), ["__c", "place"], "left").join(back(2, "two"), ["__c", "place"], "left")
    df = df.join(opening.drop("conv_id"), "__c", "left").join(other, "conv_id", "left")

    def quote(name: str, level: int) -> Column:
        marks = ">" * level + " "
        return F.concat(F.lit(marks), F.replace(F.col(name), F.lit("\n"), F.lit("\n" + marks)), F.lit("\n"))

    kinds = [(1, [("one", 1)]), (2, [("two", 2), ("one", 1)]), (3, [("two", 1)]), (4, [("other", 2), ("opening", 1)])]
    text = F.col("text")
    for kind, quotes in kinds:
        quoted = F.concat(*[quote(*q) for q in quotes], F.coalesce("text", F.lit("")))
        text = F.when((F.col("kind") == kind) & (F.col("place") > 0) & quoted.isNotNull(), quoted).otherwise(text)
    return df.select("conv_id", "turn", "role", text.alias("text"))


def test_quotations_agree_with_sql(spark):
    table = written(quoting(spark.read.parquet(f"{SF}/conversations.parquet")))
    got = quotations.conversations(table)
    con = duckdb.connect()
    con.register("conversations", table.toPandas())
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({quotations.QUOTATIONS_SQL})").fetchall()
    rows = got.collect()
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert sum(r.n_linked for r in rows) > 20 and any(r.reply_order != r.place for r in rows)


def test_very_long_and_tied_messages(spark):
    rows = [(1, 0, "u", "word " * 60_000), (1, 1, "a", "> " + "word " * 60_000 + "\nyes"), (1, 1, "a", "tie"), (1, 1, "a", "tie"), (1, 2, "u", "> tie\nok")]
    got = quotations.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted(r.reply_order for r in got) == list(range(5))
    assert sum(r.n_linked for r in got) == 2
    assert next(r for r in got if r.body == "ok").by_quote


def test_query_links_quotations(spark):
    from thalweg.llm import queries

    got = queries.op9_quotation_linking(spark, SF).collect()
    assert sum(r.n_linked for r in got) > 20 and any(r.reply_order != r.place for r in got)
