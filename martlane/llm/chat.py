"""Operator 3: chat formatting by quotation linking, in DataFrame and SQL
functions.

A line's quote level is the number of ``>`` marks it begins with.  Lines of
one level in a row are a passage.  Passages are normalised (lower case, only
letters and digits, single blanks) and hashed, whole and line by line; so are
the unquoted paragraphs and lines of every message.  A quoted piece is joined
to the first message of its conversation that has it unquoted, if that comes
before; pre-aggregating to that first message makes the join one to one,
whatever is said or quoted often.  A message answers the message of its
outermost, longest linked quote; without one it answers the turn before it,
if there is one.  Messages are put out without quotes, with their place in
reply order: by the turn they answer, then by their own.

Places come from one global sort of the conversations, dealt by ranges, so a
conversation of any length is no single task's work.

Defined results: null text is the empty text, null roles stay null; a
message with a null conversation or turn links to nothing and answers
nothing; repeated rows are all kept, in neighbouring places; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlane.llm.base import written

# possessive throughout: matched in a loop, however many marks a line has
MARKS = r"^[ \t]*+((?:>[ \t]?+)++)"


def level(line: str) -> str:
    return f"length(regexp_replace(regexp_extract({line}, r'{MARKS}', 1), '[^>]', ''))"


def body(line: str) -> str:
    return f"regexp_replace({line}, r'{MARKS}', '')"


def normal(text: str) -> str:
    return f"trim(regexp_replace(lower({text}), r'[^\\p{{L}}\\p{{N}}]+', ' '))"


def messages(conversations: DataFrame) -> DataFrame:
    """Rows with their lines: array of (level, body)."""
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    lines = f"transform(split(text, '\\n'), x -> struct({level('x')} as level, {body('x')} as body))"
    return rows.withColumn("lines", F.expr(lines))


def passages(of: Column | str) -> str:
    """Runs of lines of one level: array of (level, array of bodies).  A line
    without words ends a run, which splits paragraphs."""
    return f"""
      filter(aggregate({of}, cast(array() as array<struct<level: int, lines: array<string>>>), (a, x) ->
        case when size(a) > 0 and a[size(a) - 1].level = x.level and {normal('x.body')} <> ''
                  and size(a[size(a) - 1].lines) > 0
             then concat(slice(a, 1, size(a) - 1),
                  array(struct(x.level as level, concat(a[size(a) - 1].lines, array(x.body)) as lines)))
             when {normal('x.body')} = '' then concat(a, array(struct(x.level as level, cast(array() as array<string>) as lines)))
             else concat(a, array(struct(x.level as level, array(x.body) as lines))) end),
        p -> size(p.lines) > 0)"""


def pieces(rows: DataFrame, quoted: bool) -> DataFrame:
    """(conv_id, turn, level, words, hash): passages and their lines."""
    wanted = "level > 0" if quoted else "level = 0"
    runs = rows.select("conv_id", "turn", F.explode(F.expr(f"filter({passages('lines')}, p -> p.{wanted})")).alias("p"))
    # the whole passage, and its lines where it has several
    units = F.expr("""if(size(p.lines) = 1, p.lines, concat(array(array_join(p.lines, ' ')), p.lines))""")
    each = runs.select("conv_id", "turn", F.col("p.level").alias("level"), F.explode(units).alias("unit"))
    each = each.withColumn("unit", F.expr(normal("unit"))).where("unit <> ''")
    return each.select("conv_id", "turn", "level", F.size(F.split("unit", " ")).alias("words"), F.md5("unit").alias("hash"))


def places(rows: DataFrame, conv: str, order: list[str]) -> DataFrame:
    """``rows`` with place (from 0) within ``conv``: one range-dealt sort,
    then the ranges' sizes before each and each conversation's first rank."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = rows.repartitionByRange(parts, conv, *order).sortWithinPartitions(conv, *order)
    ranked = written(spark, ranked.withColumn("_at", F.monotonically_increasing_id()), "chat-sorted")
    ranked = ranked.withColumn("_part", F.shiftright("_at", 33))
    sizes = ranked.groupBy("_part").count()  # a row for each range
    sizes = sizes.select("_part", F.coalesce(F.sum("count").over(
        W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    ranked = ranked.join(F.broadcast(sizes), "_part").withColumn(
        "_rank", F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_at", "_base")
    first = ranked.groupBy(conv).agg(F.min("_rank").alias("_first")).withColumnRenamed(conv, "_conv")
    return ranked.join(first, ranked[conv].eqNullSafe(F.col("_conv"))).withColumn(
        "place", F.col("_rank") - F.col("_first")).drop("_rank", "_first", "_conv")


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, parent_turn, place, n_quoted (quoted lines),
    n_linked (quoted passages and lines found in earlier messages), text
    (without quoted lines)."""
    spark = conversations.sparkSession
    rows = messages(conversations)
    quotes = pieces(rows, True)
    said = written(spark, pieces(rows, False).groupBy("conv_id", "hash").agg(F.min("turn").alias("origin")).join(
        quotes.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi"), "chat-said")
    linked = quotes.join(said, ["conv_id", "hash"]).where("origin < turn").groupBy("conv_id", "turn").agg(
        F.max(F.struct(-F.col("level"), "words", "origin")).alias("best"), F.count_distinct("level", "hash").alias("n_linked"))
    linked = written(spark, linked.select(
        F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("best.origin").alias("origin"), "n_linked"), "chat-links")
    turns = rows.select(F.col("conv_id").alias("_pc"), (F.col("turn") + 1).alias("_pt")).distinct()
    out = rows.join(linked, (rows.conv_id == F.col("_c")) & (rows.turn == F.col("_t")), "left").join(
        turns, (rows.conv_id == F.col("_pc")) & (rows.turn == F.col("_pt")), "left")
    out = out.select(
        "conv_id", "turn", "role",
        F.coalesce("origin", F.when(F.col("_pt").isNotNull(), F.col("turn") - 1)).alias("parent_turn"),
        F.expr("cast(size(filter(lines, x -> x.level > 0)) as bigint)").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.expr("array_join(transform(filter(lines, x -> x.level = 0), x -> x.body), '\\n')").alias("text"))
    return places(out, "conv_id", ["parent_turn", "turn", "role", "text"]).select(
        "conv_id", "turn", "role", "parent_turn", "place", "n_quoted", "n_linked", "text")
