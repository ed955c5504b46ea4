"""Operator 6: quotation linking of conversations.

Lines that begin with quote marks (`>`, `> >`, ...) are quoted at the level of their
marks. Successive lines of one level are a passage. A passage's lines are normalised (no
marks, lower case, single spaces) and hashed, and so is the passage as a whole; the
hashes are joined to the hashes of the unquoted lines, and of the whole unquoted texts,
of earlier messages of the conversation. Each hash goes to the latest earlier message that
has it (an as-of join in two levels of turns, so that a line that is said over and over is
no hot group). A message's parent is the message that most lines of its outermost quoted
level go to, a whole-passage match counting before all lines, the latest of equals. A line
that announces a quotation ("... wrote:") belongs to it.

A conversation is then its messages without quotes, in reply order: threads in the order
of their first messages, in a thread by depth, then turn; a message that quotes nothing
known begins a thread. Threads and depths come from doubling parent links, in a number of
rounds that grows with the logarithm of the deepest reply.

Nulls: a null text is empty. Messages with a null conversation or turn link to nothing and
are threads of their own. Messages with equal conversation and turn are kept, with one
parent: their quotes count together. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maillage.llm.common import stored

#: Marks at the start of a quoted line; ends of lines that announce one.
MARKS = r"^((?:[ \t]{0,3}>)+)"
ANNOUNCES = r"(?i)\b(?:wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$"
#: Turns of a block of the as-of join.
BLOCK_TURNS = 256


def level(line: Column) -> Column:
    """Quote level: number of marks."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), r"[ \t]", ""))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """Messages with `lines`: (level, said, text) each, in order; `said`: belongs to the message itself."""
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.struct(level(x).alias("level"), F.regexp_replace(x, MARKS, "").alias("text"), x.alias("whole")))

    def marked(x: Column, i: Column) -> Column:
        announces = F.regexp_like(x["whole"], F.lit(ANNOUNCES)) & (F.coalesce(F.get(F.col("_lines"), i + 1)["level"], F.lit(0)) > 0)
        return F.struct(x["level"].alias("level"), ((x["level"] == 0) & ~announces).alias("said"), x["text"].alias("text"))

    return messages.withColumn("_lines", lines).withColumn("lines", F.transform("_lines", marked)).drop("_lines")


def passages(lines: Column) -> Column:
    """Quoted passages: (level, lines) of successive quoted lines of one level. Linear in
    the lines: a run is cut out between the places where the level changes."""
    at = lambda i: F.coalesce(F.get(lines, i)["level"], F.lit(-1))
    places = F.when(F.size(lines) > 0, F.sequence(F.lit(0), F.size(lines) - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(places, lambda i: at(i) != at(i - 1))

    def runs(starts: Column) -> Column:
        def run(start: Column, nth: Column) -> Column:
            end = F.coalesce(F.get(starts, nth + 1), F.size(lines))
            texts = F.transform(F.slice(lines, start + 1, end - start), lambda x: x["text"])
            return F.struct(at(start).alias("level"), texts.alias("lines"))

        return F.transform(starts, run)

    every = F.element_at(F.transform(F.array(starts), runs), 1)
    return F.filter(every, lambda p: p["level"] > 0)


def linked(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Rows (conv, turn, level, whole, hash, source): each quoted line and passage, and the
    turn of the latest earlier message that has it (null: none)."""
    rows = parsed(messages).where(F.col(conv).isNotNull() & F.col(turn).isNotNull()).select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), "lines")
    digest = lambda t: F.xxhash64(normalised(t))
    quoted = rows.where(F.exists("lines", lambda x: x["level"] > 0)).select("conv", "turn", F.explode(passages(F.col("lines"))).alias("p"))
    quoted = quoted.select("conv", "turn", "p.level", F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), F.array_join("p.lines", " ").alias("text"))),
        F.transform("p.lines", lambda x: F.struct(F.lit(False).alias("whole"), x.alias("text"))),
    )).alias("q")).where(normalised(F.col("q.text")) != "").select("conv", "turn", "level", "q.whole", digest(F.col("q.text")).alias("hash"))
    said = F.filter("lines", lambda x: x["said"])
    told = rows.select("conv", "turn", F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), F.array_join(F.transform(said, lambda x: x["text"]), " ").alias("text"))),
        F.transform(said, lambda x: F.struct(F.lit(False).alias("whole"), x["text"].alias("text"))),
    )).alias("q")).select("conv", "turn", "q.whole", digest(F.col("q.text")).alias("hash"))
    key = ["conv", "whole", "hash"]
    # Only what is quoted somewhere in the conversation has to be compared.
    told = told.join(quoted.select(key).distinct(), key, "left_semi").distinct()
    block = F.floor(F.col("turn") / block_turns)
    both = quoted.withColumn("asks", F.lit(True)).unionByName(told.withColumn("asks", F.lit(False)), allowMissingColumns=True).withColumn("block", block)
    before = Window.partitionBy(*key, "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("source", F.max(F.when(~F.col("asks"), F.col("turn"))).over(before)).where("asks")
    ends = told.groupBy(*key, block.alias("block")).agg(F.max("turn").alias("last"))
    ends = ends.union(quoted.select(*key, block.alias("block"), F.lit(None).cast("long")).distinct()).groupBy(*key, "block").agg(F.max("last").alias("last"))
    earlier = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("until", F.max("last").over(earlier)).select(*key, "block", "until")
    found = near.join(ends, [*key, "block"], "left").withColumn("source", F.coalesce("source", "until"))
    return found.select(F.col("conv").alias(conv), F.col("turn").alias(turn), "level", "whole", "hash", "source")


def parents(links: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Rows (conv, turn, parent): the message each one answers."""
    votes = links.where("source is not null").groupBy(conv, turn, "level", "source").agg(F.sum(F.col("whole").cast("int")).alias("wholes"), F.count("*").alias("votes"))
    best = F.max(F.struct((-F.col("level")).alias("l"), F.col("wholes"), F.col("votes"), F.col("source")))
    return votes.groupBy(conv, turn).agg(best.alias("best")).select(conv, turn, F.col("best.source").alias("parent"))


def threads(links: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Rows (conv, turn, parent, root, depth) of messages with parents, by doubling."""
    rows = stored(links.select(conv, turn, "parent", F.col("parent").alias("root"), F.lit(1).alias("depth")))
    while True:
        up = rows.select(F.col(conv), F.col(turn).alias("root"), F.col("root").alias("up_root"), F.col("depth").alias("up_depth"))
        met = rows.join(up, [conv, "root"], "left")
        if not met.where("up_root is not null").limit(1).count():
            return rows
        rows = stored(met.select(conv, turn, "parent", F.coalesce("up_root", "root").alias("root"), (F.col("depth") + F.coalesce("up_depth", F.lit(0))).alias("depth")))


def conversations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The messages (conv, turn, role, text) with their texts without quotes, and
    parent_turn, thread_turn, depth, n_quoted (lines) and n_linked (quoted lines with a
    known source). Reply order is (conv, thread_turn, depth, turn). Other columns are left out."""
    messages = messages.select(conv, turn, "role", "text")
    links = stored(linked(messages, conv, turn))
    found = threads(parents(links, conv, turn), conv, turn)
    counts = links.where("not whole").groupBy(conv, turn).agg(F.count("source").alias("n_linked"))
    own = F.array_join(F.transform(F.filter("lines", lambda x: x["said"]), lambda x: x["text"]), "\n")
    has_quotes = F.exists("lines", lambda x: ~x["said"])
    rows = parsed(messages)
    rows = rows.withColumn("text", F.when(has_quotes, F.regexp_replace(F.trim(F.regexp_replace(own, r"\n{3,}", "\n\n")), r"^\n+|\n+$", "")).otherwise(F.coalesce("text", F.lit(""))))
    rows = rows.withColumn("n_quoted", F.size(F.filter("lines", lambda x: x["level"] > 0))).drop("lines")
    rows = rows.join(found.join(counts, [conv, turn], "left"), [conv, turn], "left")
    return rows.select(*messages.columns, F.col("parent").alias("parent_turn"), F.coalesce("root", turn).alias("thread_turn"), F.coalesce("depth", F.lit(0)).alias("depth"), "n_quoted", F.coalesce("n_linked", F.lit(0)).alias("n_linked"))
