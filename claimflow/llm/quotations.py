"""Quotation linking: conversations in reply order, without the quoted lines. DataFrame functions only.

A line's quote level is the number of ``>`` before its text. Lines of one level in a row are a quoted passage.
The passage, its paragraphs and its lines are normalised (one space between words, A to Z
lower-cased) and hashed, and meet the hashes of what messages of the conversation wrote
themselves; the first message that wrote something is its origin. A message replies to the origin
of most of its lowest quote level. A thread is a message that replies to none and all replies below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.scratch import save

#: White space, as in words.
_BLANK = r"[\x20\x09-\x0D]"
_QUOTE = r"^[\x20\x09]*>[\x20\x09>]*"
#: A line that only announces a quotation, before a quoted line.
_ANNOUNCE = r"(wrote|writes|schrieb|écrit|escribió)[\x20\x09]*:[\x20\x09]*$"
#: Bits of a row's number within its range partition, as monotonically_increasing_id has them.
_ROW_BITS = 33


def normalised(text: Column) -> Column:
    one = F.trim(F.regexp_replace(text, f"{_BLANK}+", " "))
    return F.translate(one, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _level(line: Column) -> Column:
    marks = F.regexp_extract(line, _QUOTE, 0)
    return F.length(F.regexp_replace(marks, r"[\x20\x09]", ""))


def _units(text: Column) -> Column:
    """The normalised text, its paragraphs and its lines."""
    every = F.concat(F.array(text), F.split(text, r"\n[\x20\x09]*\n"), F.split(text, "\n"))
    return F.array_distinct(F.filter(F.transform(every, normalised), lambda u: F.length(u) > 0))


def parse(messages: DataFrame) -> DataFrame:
    """messages (conv_id, turn, role, text) with ``own``, the text without quotations, and ``passages`` (level, body)."""
    quoting = F.coalesce(F.col("text").rlike(r"(?m)^[\x20\x09]*>"), F.lit(False))
    lines = F.when(quoting, F.split("text", "\n"))
    parsed = messages.withColumn("lines", lines).withColumn("levels", F.transform("lines", _level))
    many = F.size("lines")
    level = lambda i: F.get("levels", i)
    own = F.filter("lines", lambda line, i: (level(i) == 0) & ~(F.coalesce(level(i + 1) > 0, F.lit(False)) & line.rlike(_ANNOUNCE)))
    starts = F.filter(F.sequence(F.lit(0), many - 1), lambda i: F.coalesce(level(i) != level(i - 1), F.lit(True)))
    parsed = parsed.withColumn("starts", starts)

    def passage(start: Column, i: Column) -> Column:
        upto = F.coalesce(F.get("starts", i + 1), many)
        body = F.transform(F.slice("lines", start + 1, upto - start), lambda line: F.regexp_replace(line, _QUOTE, ""))
        return F.struct(level(start).alias("level"), F.array_join(body, "\n").alias("body"))

    passages = F.filter(F.transform("starts", passage), lambda p: p["level"] > 0)
    kept = F.when(quoting, F.regexp_replace(F.array_join(own, "\n"), f"^{_BLANK}+|{_BLANK}+$", "")).otherwise(F.col("text"))
    return parsed.select("conv_id", "turn", "role", "text", kept.alias("own"), F.when(quoting, passages).alias("passages"))


def _replies(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to) of messages with a quotation whose origin is an earlier message."""
    quoted = parsed.filter("passages IS NOT NULL").select("conv_id", "turn", F.explode("passages").alias("passage"))
    quoted = quoted.select("conv_id", "turn", "passage.level", F.explode(_units(F.col("passage.body"))).alias("unit")).distinct()
    quoted = quoted.select("conv_id", "turn", "level", F.sha2("unit", 256).alias("hash"), F.length("unit").alias("size"))
    wanted = parsed.filter("passages IS NOT NULL").select("conv_id").distinct()
    origins = parsed.filter("own IS NOT NULL").join(wanted, "conv_id", "left_semi").select("conv_id", "turn", F.explode(_units(F.col("own"))).alias("unit"))
    origins = origins.groupBy("conv_id", F.sha2("unit", 256).alias("hash")).agg(F.min("turn").alias("origin"))
    linked = quoted.join(origins, ["conv_id", "hash"]).filter("origin < turn")
    scored = linked.groupBy("conv_id", "turn", "level", "origin").agg(F.sum("size").alias("size"))
    best = F.max(F.struct((-F.col("level")).alias("level"), "size", "origin"))
    return scored.groupBy("conv_id", "turn").agg(best.alias("best")).select("conv_id", "turn", F.col("best.origin").alias("reply_to"))


def _roots(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, depth, root): paths are halved until all end at a message that replies to none."""
    current = save(replies.select("conv_id", "turn", "reply_to", F.lit(1).cast("bigint").alias("depth"), F.col("reply_to").alias("root")), "replies")
    while True:
        above = current.select("conv_id", F.col("turn").alias("root"), F.col("depth").alias("more"), F.col("root").alias("next"))
        following = save(current.join(above, ["conv_id", "root"], "left").select(
            "conv_id", "turn", "reply_to", (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "replies")
        moved = following.filter("moved").head(1)
        current = following.drop("moved")
        if not moved:
            return current


def reply_order(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, position, turn, role, text, reply_to, depth, root, quotes.

    messages has conv_id, turn, role and text; other columns are ignored. ``text`` has no quotations any
    more, ``reply_to`` is the turn of the message replied to (NULL if no quotation has an origin),
    ``root`` the first turn of the thread, ``quotes`` the number of quoted passages. ``position`` counts
    from 0 within a conversation: threads by their root, within a thread by turn, so a reply stands after what it replies to.

    A NULL text stays NULL, an empty one empty, and quotes nothing. Messages without conv_id or
    turn have neither replies nor origins; those without conv_id form one conversation in position.
    Repeated rows each get a position. An empty table gives an empty table.

    A conversation of any length is split: the rows are dealt by ranges of their order, numbered within
    a range, and shifted by the number of rows before it.
    """
    kinds = dict(messages.dtypes)
    parsed = save(parse(messages.select("conv_id", "turn", "role", "text")).withColumn("row", F.monotonically_increasing_id()), "messages")
    linked = _roots(_replies(parsed))
    narrow = parsed.select("row", "conv_id", "turn", "role", F.md5(F.coalesce("text", F.lit(""))).alias("print")).join(linked, ["conv_id", "turn"], "left")
    narrow = narrow.withColumn("root", F.coalesce("root", "turn")).withColumn("depth", F.coalesce("depth", F.lit(0).cast("bigint")))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "root", "turn", "role", "print", "row")]
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ranged = save(ranged.select("row", "conv_id", "reply_to", "depth", "root", "at", F.shiftright("at", _ROW_BITS).alias("part")), "order")
    parts = ranged.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("many"))
    before = F.sum("many").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = save(parts.select("conv_id", "part", "first", F.coalesce(before, F.lit(0)).alias("before")), "parts")
    placed = ranged.alias("r").join(parts.alias("p"), F.col("r.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("r.part") == F.col("p.part")))
    placed = placed.select("r.row", "r.reply_to", "r.depth", "r.root", (F.col("p.before") + F.col("r.at") - F.col("p.first")).alias("position"))
    return parsed.join(placed, "row").select(
        "conv_id", "position", "turn", "role", F.col("own").alias("text"), F.col("reply_to").cast(kinds["turn"]).alias("reply_to"), "depth",
        F.col("root").cast(kinds["turn"]).alias("root"), F.coalesce(F.size("passages"), F.lit(0)).cast("bigint").alias("quotes"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return reply_order(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: The same by lines, with a walk up the replies.
SQL = r"""
WITH RECURSIVE given AS MATERIALIZED (
  SELECT row_number() OVER () AS id, conv_id, turn, role, text,
    coalesce(regexp_matches(text, '(^|\n)[\x20\x09]*>'), false) AS quoting FROM conversations),
lines AS MATERIALIZED (
  SELECT id, conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM given WHERE quoting),
levels AS MATERIALIZED (
  SELECT *, len(regexp_replace(regexp_extract(line, '^[\x20\x09]*>[\x20\x09>]*'), '[\x20\x09]', '', 'g')) AS level FROM lines),
marked AS MATERIALIZED (
  SELECT *, lead(level) OVER w AS following, (lag(level) OVER w IS DISTINCT FROM level)::INT AS fresh FROM levels WINDOW w AS (PARTITION BY id ORDER BY i)),
owned AS (
  SELECT id, string_agg(line, chr(10) ORDER BY i) AS own FROM marked
  WHERE level = 0 AND NOT (coalesce(following > 0, false) AND regexp_matches(line, '(wrote|writes|schrieb|écrit|escribió)[\x20\x09]*:[\x20\x09]*$')) GROUP BY id),
own AS MATERIALIZED (
  SELECT g.*, CASE WHEN quoting THEN regexp_replace(coalesce(own, ''), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') ELSE text END AS own
  FROM given g LEFT JOIN owned USING (id)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY id ORDER BY i) AS passage FROM marked),
passages AS MATERIALIZED (
  SELECT id, conv_id, turn, passage, any_value(level) AS level, string_agg(regexp_replace(line, '^[\x20\x09]*>[\x20\x09>]*', ''), chr(10) ORDER BY i) AS body
  FROM numbered WHERE level > 0 GROUP BY id, conv_id, turn, passage),
texts AS (
  SELECT conv_id, turn, level, body FROM passages
  UNION ALL SELECT conv_id, turn, 0, own FROM own WHERE own IS NOT NULL AND conv_id IN (SELECT conv_id FROM passages)),
units AS MATERIALIZED (
  SELECT DISTINCT conv_id, turn, level, translate(trim(regexp_replace(unit, '[\x20\x09-\x0D]+', ' ', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS unit
  FROM (SELECT conv_id, turn, level, unnest(list_concat([body], regexp_split_to_array(body, '\n[\x20\x09]*\n'), string_split(body, chr(10)))) AS unit FROM texts)),
origins AS (SELECT conv_id, unit, min(turn) AS origin FROM units WHERE level = 0 AND unit <> '' GROUP BY ALL),
scored AS (
  SELECT conv_id, turn, level, origin, sum(len(unit)) AS size FROM units JOIN origins USING (conv_id, unit) WHERE level > 0 AND origin < turn GROUP BY ALL),
replies AS MATERIALIZED (
  SELECT conv_id, turn, origin AS reply_to FROM scored
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, size DESC, origin DESC) = 1),
walk(conv_id, turn, at_, depth) AS (
  SELECT conv_id, turn, reply_to, 1 FROM replies
  UNION ALL SELECT w.conv_id, w.turn, r.reply_to, depth + 1 FROM walk w JOIN replies r ON r.conv_id = w.conv_id AND r.turn = w.at_),
roots AS (SELECT conv_id, turn, arg_max(at_, depth) AS root, max(depth) AS depth FROM walk GROUP BY ALL),
counted AS (SELECT id, count(*) AS quotes FROM passages GROUP BY id)
SELECT o.conv_id, row_number() OVER (PARTITION BY o.conv_id
    ORDER BY coalesce(root, o.turn) NULLS FIRST, o.turn NULLS FIRST, role NULLS FIRST, md5(coalesce(text, ''))) - 1 AS position,
  o.turn, role, own AS text, reply_to, coalesce(depth, 0)::BIGINT AS depth, coalesce(root, o.turn) AS root, coalesce(quotes, 0)::BIGINT AS quotes
FROM own o LEFT JOIN replies r ON r.conv_id = o.conv_id AND r.turn = o.turn
LEFT JOIN roots t ON t.conv_id = o.conv_id AND t.turn = o.turn LEFT JOIN counted c ON c.id = o.id
"""
