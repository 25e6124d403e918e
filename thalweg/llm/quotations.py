"""Chat formatting by quotation linking.

Lines of a message that begin with quote marks (``>``, nested as ``>>`` or ``> >``) are quotes of that level; runs of
lines of one level are passages. Passages and original messages are normalised (lower case, white space as one blank)
and hashed; a quoted passage is joined to the first message that has it as its whole text, one of its paragraphs or one
of its lines: in the same conversation before the quoting message, or else in any other. A message replies to the latest
message of its conversation that it quotes at level 1, or else to the message before it. Conversations come out as rows
in reply order (messages by the place of what they reply to, then by their own), without quotes, formatted as chat turns.

Originals are pre-aggregated by hash and written before the joins, which can then split a common line, and places in a
conversation are counted by ranges of turns, so a conversation or line of any number of rows is no hot task. Only rows
of one conversation with equal turns, or replies to one message, are a range that is not cut.

A passage is linked if it equals a whole message, a paragraph or a line; other excerpts have no origin.

Nulls: a null text is empty; a null conversation is one of its own; a null turn comes first; a null role is ``unknown``.
Rows of equal conversation and turn are ordered by role and text. An empty table gives an empty result. Other columns
are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, need, running_before, written

#: Turns of a range in which places are counted.
RANGE = 1024
_MARKS = r"^((?:[ \t]*>)+)"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))


def _key(text: Column) -> Column:
    return F.md5(normalised(text).cast("binary"))


def parsed_lines(text: Column) -> Column:
    """Array of (level, body): the depth of quote marks of each line, and what follows them."""

    def line(x: Column) -> Column:
        marks = F.regexp_extract(x, _MARKS, 1)
        level = F.char_length(F.regexp_replace(marks, "[^>]", ""))
        return F.struct(level.alias("level"), F.regexp_replace(x, _MARKS + " ?", "").alias("body"))

    return F.transform(F.split(text, r"\r?\n"), line)


def passages(lines: Column) -> Column:
    """Array of (level, text): runs of quoted lines of one level, joined by line feeds; blank ones are left out."""
    none = F.array().cast("array<struct<level:int,text:string>>")
    start = F.struct(none.alias("done"), F.lit(0).alias("level"), F.lit("").alias("text"))

    def closed(acc: Column) -> Column:
        one = F.array(F.struct(acc["level"].alias("level"), acc["text"].alias("text")))
        return F.when((acc["level"] > 0) & (F.trim(acc["text"]) != ""), F.concat(acc["done"], one)).otherwise(acc["done"])

    def step(acc: Column, x: Column) -> Column:
        same = acc["level"] == x["level"]
        return F.struct(
            F.when(same, acc["done"]).otherwise(closed(acc)).alias("done"),
            x["level"].alias("level"),
            F.when(same, F.concat(acc["text"], F.lit("\n"), x["body"])).otherwise(x["body"]).alias("text"),
        )

    return F.aggregate(lines, start, step, closed)


def parse(messages: DataFrame) -> DataFrame:
    """``messages`` with body (the text without quotes) and quotes: (level, text) of each passage."""
    need(messages, "conv_id", "turn", "role", "text")
    whole = F.coalesce(F.col("text"), F.lit(""))

    def of(lines: Column) -> Column:
        own = F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["body"])
        return F.struct(F.trim(F.concat_ws("\n", own)).alias("body"), passages(lines).alias("quotes"))

    kept = messages.drop("body", "quotes")
    return kept.withColumn("__p", let(parsed_lines(whole), of)).select("*", "__p.*").drop("__p")


def placed(messages: DataFrame) -> DataFrame:
    """``messages`` with place: the number of earlier rows of the conversation."""
    df = messages.withColumn("__c", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null")))
    df = df.withColumn("__range", F.coalesce(F.floor(F.col("turn") / RANGE), F.lit(-(1 << 62))))
    df = df.withColumn("__one", F.lit(1).cast("long"))
    order = [F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.xxhash64("text")]
    return running_before(df, ["__c"], "__range", order, "__one", "place").drop("__range", "__one")


def originals(parsed: DataFrame) -> DataFrame:
    """(hash, __c, place) for the whole body, the paragraphs and the lines of each message."""
    body = F.col("body")
    parts = F.array_distinct(F.concat(F.array(body), F.split(body, r"\n\s*\n"), F.split(body, "\n")))
    rows = parsed.where(F.trim(body) != "").select("__c", "place", F.explode(parts).alias("part"))
    return rows.where(F.trim("part") != "").select(_key(F.col("part")).alias("hash"), "__c", "place")


def links(parsed: DataFrame) -> DataFrame:
    """(__c, place, level, quote, hash, origin_c, origin_place) of each quoted passage; origin null if it has none."""
    quoted = parsed.where(F.size("quotes") > 0).select("__c", "place", F.posexplode("quotes").alias("quote", "q"))
    quoted = quoted.select("__c", "place", F.col("q.level").alias("level"), "quote", _key(F.col("q.text")).alias("hash"))
    found = originals(parsed)
    inside = written(found.groupBy("hash", "__c").agg(F.min("place").alias("in_place")))
    anywhere = inside.groupBy("hash").agg(
        F.min(F.struct("__c", "in_place")).alias("least"), F.max(F.struct("__c", "in_place")).alias("most")
    )
    df = quoted.join(inside, ["hash", "__c"], "left").join(written(anywhere), "hash", "left")
    here = F.col("in_place") < F.col("place")
    other = F.when(F.col("least.__c") != F.col("__c"), F.col("least")).when(F.col("most.__c") != F.col("__c"), F.col("most"))
    return df.select(
        "__c", "place", "level", "quote", "hash",
        F.when(here, F.col("__c")).otherwise(other["__c"]).alias("origin_c"),
        F.when(here, F.col("in_place")).otherwise(other["in_place"]).alias("origin_place"),
    )


def chat(role: Column, body: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), body, F.lit("<|im_end|>\n"))


def conversations(messages: DataFrame) -> DataFrame:
    """One row a message: conv_id, turn, role, body, place, n_quotes, max_level, n_linked, reply_to (the place of the
    message replied to, null for the first), by_quote, reply_order (from 0, gapless in a conversation), chat."""
    need(messages, "conv_id", "turn", "role", "text")
    parsed = written(placed(parse(messages.select("conv_id", "turn", "role", "text"))))
    linked = links(parsed)
    own = linked.where("level = 1 and origin_c = __c").groupBy("__c", "place").agg(F.max("origin_place").alias("quoted"))
    n = linked.where("origin_c is not null").groupBy("__c", "place").agg(F.count(F.lit(1)).alias("n_linked"))
    df = parsed.join(own, ["__c", "place"], "left").join(n, ["__c", "place"], "left")
    before = F.when(F.col("place") > 0, F.col("place") - 1)
    df = df.withColumn("reply_to", F.coalesce("quoted", before))
    df = df.withColumn("__range", F.floor(F.coalesce("reply_to", F.lit(-1)) / RANGE)).withColumn("__one", F.lit(1).cast("long"))
    df = running_before(df, ["__c"], "__range", [F.asc_nulls_first("reply_to"), F.col("place")], "__one", "reply_order")
    role = F.coalesce("role", F.lit("unknown"))
    return df.select(
        "conv_id", "turn", "role", "body", "place",
        F.size("quotes").cast("long").alias("n_quotes"),
        F.coalesce(F.array_max(F.transform("quotes", lambda q: q["level"])), F.lit(0)).alias("max_level"),
        F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
        "reply_to",
        F.col("quoted").isNotNull().alias("by_quote"),
        "reply_order",
        chat(role, F.col("body")).alias("chat"),
    )


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


#: The same in DuckDB's SQL.
QUOTATIONS_SQL = r"""
WITH m AS (
  SELECT row_number() OVER () AS id, *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST) - 1 AS place
  FROM conversations
), cut AS (
  SELECT id, unnest(string_split_regex(coalesce(text, ''), '\r?\n')) AS line,
    generate_subscripts(string_split_regex(coalesce(text, ''), '\r?\n'), 1) AS i FROM m
), lines AS (
  SELECT id, i, len(regexp_replace(regexp_extract(line, '^((?:[ \t]*>)+)', 1), '[^>]', '', 'g')) AS level,
    regexp_replace(line, '^((?:[ \t]*>)+) ?', '') AS body FROM cut
), own AS (
  SELECT id, trim(string_agg(body, chr(10) ORDER BY i), ' ') AS body FROM lines WHERE level = 0 GROUP BY id
), runs AS (
  SELECT *, i - row_number() OVER (PARTITION BY id, level ORDER BY i) AS run FROM lines WHERE level > 0
), passages AS (
  SELECT id, level, string_agg(body, chr(10) ORDER BY i) AS text FROM runs GROUP BY id, level, run
), quotes AS (
  SELECT p.id, p.level, m.conv_id, m.place,
    md5(trim(regexp_replace(lower(p.text), '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS hash
  FROM passages p JOIN m ON m.id = p.id WHERE trim(p.text, ' ') <> ''
), bodies AS (
  SELECT m.id, m.conv_id, m.place, o.body FROM m JOIN own o ON o.id = m.id WHERE trim(o.body, ' ') <> ''
), parts AS (
  SELECT conv_id, place, body AS part FROM bodies
  UNION SELECT conv_id, place, unnest(string_split_regex(body, '\n\s*\n')) FROM bodies
  UNION SELECT conv_id, place, unnest(string_split(body, chr(10))) FROM bodies
), originals AS (
  SELECT conv_id, min(place) AS place, md5(trim(regexp_replace(lower(part), '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS hash
  FROM parts WHERE trim(part, ' ') <> '' GROUP BY conv_id, hash
), linked AS (
  SELECT q.id, q.level, max(CASE WHEN o.conv_id IS NOT DISTINCT FROM q.conv_id AND o.place < q.place THEN o.place END) AS here,
    count(CASE WHEN o.conv_id IS DISTINCT FROM q.conv_id THEN o.place END) AS others
  FROM (SELECT row_number() OVER () AS q, * FROM quotes) q LEFT JOIN originals o ON o.hash = q.hash GROUP BY q.q, q.id, q.level
), summed AS (
  SELECT id, count(*) AS n_quotes, max(level) AS max_level, count(CASE WHEN here IS NOT NULL OR others > 0 THEN 1 END) AS n_linked,
    max(CASE WHEN level = 1 THEN here END) AS quoted FROM linked GROUP BY id
), replies AS (
  SELECT m.*, coalesce(o.body, '') AS body, s.n_quotes, s.max_level, s.n_linked, s.quoted,
    coalesce(s.quoted, CASE WHEN m.place > 0 THEN m.place - 1 END) AS reply_to
  FROM m LEFT JOIN own o ON o.id = m.id LEFT JOIN summed s ON s.id = m.id
)
SELECT conv_id, turn, role, body, place, CAST(coalesce(n_quotes, 0) AS BIGINT) AS n_quotes, CAST(coalesce(max_level, 0) AS INT) AS max_level,
  CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked, reply_to, quoted IS NOT NULL AS by_quote,
  row_number() OVER (PARTITION BY conv_id ORDER BY reply_to NULLS FIRST, place) - 1 AS reply_order,
  '<|im_start|>' || coalesce(role, 'unknown') || chr(10) || body || '<|im_end|>' || chr(10) AS chat
FROM replies
"""

#: The same, of the table with quotations (``quoting``).
QUOTING_SQL = r"""
WITH plain AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST) - 1 AS place FROM conversations
), kinds AS (
  SELECT p.*, o.text AS one, t.text AS two, f.text AS opening, x.text AS other FROM plain p
  LEFT JOIN plain o ON o.conv_id IS NOT DISTINCT FROM p.conv_id AND o.place = p.place - 1
  LEFT JOIN plain t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.place = p.place - 2
  LEFT JOIN plain f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.place = 0
  LEFT JOIN plain x ON x.conv_id = p.conv_id - 1 AND x.place = 0
), hashed AS (
  SELECT *, CAST('0x' || substr(md5(coalesce(CAST(conv_id AS VARCHAR), '') || ':' || place), 1, 8) AS BIGINT) % 5 AS kind FROM kinds
), conversing AS (
  SELECT conv_id, turn, role, coalesce(CASE WHEN place > 0 THEN CASE kind
    WHEN 1 THEN '> ' || replace(one, chr(10), chr(10) || '> ') || chr(10) || coalesce(text, '')
    WHEN 2 THEN '>> ' || replace(two, chr(10), chr(10) || '>> ') || chr(10) || '> ' || replace(one, chr(10), chr(10) || '> ') || chr(10) || coalesce(text, '')
    WHEN 3 THEN '> ' || replace(two, chr(10), chr(10) || '> ') || chr(10) || coalesce(text, '')
    WHEN 4 THEN '>> ' || replace(other, chr(10), chr(10) || '>> ') || chr(10) || '> ' || replace(opening, chr(10), chr(10) || '> ') || chr(10) || coalesce(text, '')
    END END, text) AS text FROM hashed
), """ + QUOTATIONS_SQL.replace("\nWITH ", "", 1).replace("FROM conversations\n", "FROM conversing\n", 1)
