"""Reply-ordered conversations by quotation linking.

A message's lines that begin with ``>`` are quotes, and the number of ``>`` before the text is the quote
level; the other lines are its own.  Lines are normalised (markers off, white space as one blank, lower case)
and hashed, and so are passages: the consecutive lines of one level up to a blank line, joined, so that a quote
may be wrapped elsewhere than its original.  A quoted line or passage belongs to the earliest message that has it as
its own line or passage: in the same conversation before the quoting one, however short it is, or else, with
``MIN_WORDS`` words, in a conversation with a smaller id.  The message that most
of the lines and passages of the lowest quote level with any match belong to is the one replied to (ties: the latest).  A message without
such a match replies to the one before it in its conversation.  A parent thus always comes before its
reply in the order of conversation and turn, so the replies form trees: the conversations.

Messages are ordered in their tree by depth, conversation and turn, so each follows the message it
answers.  ``body`` is the message without quotes and the line that announces them, ``chat`` the same in chat markup.

Frequent lines are grouped to one row a line (and conversation) before any join.  The message before is found
in range partitions, and positions in a tree from counts of each tree in each range partition, so
neither a long conversation nor a large tree has to fit one task.

Defined cases: a null text is empty; null roles stay null (``chat``: ``unknown``); rows with the same
``conv_id`` and ``turn`` are told apart by a hash of role and text, and equal rows count as one message;
null ids come first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from txgraph.llm.common import parts_for, table
from txgraph.session import cut

#: Words that a quoted line or passage needs to be a link to another conversation, where short ones are ambiguous.
MIN_WORDS = 3
#: Letters of scripts without blanks; two of them count as a word.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\u3000-\u303F\uFF00-\uFF65]"
MARK = r"^\s*(>\s*)+"


def level(line: Column) -> Column:
    """Quote level of a line, 0 for the message's own."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARK, 0), r"[^>]", ""))


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, MARK, ""), r"\s+", " ")))


def _read(text: Column) -> Column:
    """``level, line`` of each line of a message, in an array."""
    return F.transform(F.split(text, "\n"), lambda x: F.struct(level(x).alias("level"), normal(x).alias("line")))


def _joined(lines: str) -> Column:
    """The passages of an array column ``lines`` of ``level, line``."""
    x = F.col(lines)
    blank = lambda i: F.length(F.get(x, i)["line"]) == 0
    at = F.filter(F.sequence(F.lit(0), F.size(x) - 1), lambda i: (i == 0) | blank(i) | blank(i - 1) | (F.get(x, i)["level"] != F.get(x, i - 1)["level"]))
    run = lambda a, b: F.struct(F.get(x, a)["level"].alias("level"), F.array_join(
        F.transform(F.slice(x, a + 1, b - a), lambda e: e["line"]), " ").alias("line"))
    ends = F.concat(F.slice(at, 2, F.size(at)), F.array(F.size(x)))
    return F.zip_with(at, ends, run)


def n_words(line: Column) -> Column:
    return F.size(F.split(line, " ")) + F.floor(F.length(F.regexp_replace(line, f"(?!{UNSPACED}).", "")) / 2)


def body(text: Column) -> Column:
    """Own lines of a message, without the line that announces a quote."""
    lines = F.split(text, "\n")
    n = F.size(lines)
    quoted = lambda x: F.rlike(x, F.lit(MARK))
    announces = lambda x, i: F.rlike(x, F.lit(r"(?i)^\s*on .*wrote:\s*$")) & (i + 1 < n) & quoted(F.get(lines, i + 1))
    return F.trim(F.array_join(F.filter(lines, lambda x, i: ~quoted(x) & ~F.coalesce(announces(x, i), F.lit(False))), "\n"))


def _numbered(df: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """``df`` in range partitions of ``keys``, with ``part`` and ``prev``: the payload of the row before; a written table."""
    spark = df.sparkSession
    asc = [F.col(k).asc_nulls_first() for k in keys]
    df = cut(df.repartitionByRange(parts_for(0, spark), *asc).withColumn("part", F.spark_partition_id()))
    me = F.struct(*payload)
    last = df.groupBy("part").agg(F.max_by(me, F.struct(*keys)).alias("last"))  # one row a partition
    ends = last.select("part", F.lag("last").over(W.orderBy("part")).alias("last"))
    return (df.withColumn("prev", F.lag(me).over(W.partitionBy("part").orderBy(*asc))).join(ends, "part", "left")
            .withColumn("prev", F.coalesce("prev", "last")).drop("last"))


def messages(conversations: DataFrame) -> DataFrame:
    """Distinct messages with an ``id`` that ascends with conversation, turn and hash; a written table."""
    m = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role",
                             F.coalesce("text", F.lit("")).alias("text"))
    m = m.withColumn("h", F.xxhash64("role", "text")).dropDuplicates(["conv_id", "turn", "h"])
    asc = [F.col(k).asc_nulls_first() for k in ("conv_id", "turn", "h")]
    return cut(m.repartitionByRange(parts_for(0, conversations.sparkSession), *asc).sortWithinPartitions(*asc)
               .withColumn("id", F.monotonically_increasing_id()))


def parents(m: DataFrame) -> DataFrame:
    """``id, conv_id, turn, parent, linked`` of each message: the one replied to (null: none), and whether by a quote."""
    lines = m.select("id", "conv_id", _read(F.col("text")).alias("lines")) \
        .select("id", "conv_id", F.explode(F.concat(F.col("lines"), _joined("lines"))).alias("x")) \
        .select("id", "conv_id", "x.level", F.regexp_replace("x.line", f"(?<={UNSPACED}) (?={UNSPACED})", "").alias("line")) \
        .where(F.length("line") > 0) \
        .select("id", "conv_id", "level", (n_words(F.col("line")) >= MIN_WORDS).alias("far"),
                F.xxhash64("line").alias("l1"), F.xxhash64(F.lit(1), "line").alias("l2")).distinct()
    lines = cut(lines)
    own, quoted = lines.where("level = 0"), lines.where("level > 0")
    here = own.groupBy("conv_id", "l1", "l2").agg(F.min("id").alias("here"))
    wide = own.where("far").groupBy("l1", "l2").agg(F.min(F.struct("id", "conv_id")).alias("wide"))
    q = (quoted.alias("q").join(here.alias("o"), F.col("q.conv_id").eqNullSafe(F.col("o.conv_id")) & (F.col("q.l1") == F.col("o.l1"))
                                & (F.col("q.l2") == F.col("o.l2")) & (F.col("o.here") < F.col("q.id")), "left")
         .select("q.*", "here").join(wide, ["l1", "l2"], "left"))
    source = F.coalesce("here", F.when(F.col("wide.conv_id") < F.col("conv_id"), F.col("wide.id")))
    votes = q.select("id", "level", source.alias("parent")).where("parent is not null") \
        .groupBy("id", "level", "parent").agg(F.count("*").alias("n"))
    best = votes.groupBy("id").agg(F.max_by("parent", F.struct(-F.col("level"), "n", "parent")).alias("quoted"))
    prev = _numbered(m.select("id", "conv_id", "turn"), ["id"], ["id", "conv_id"])
    before = F.when(F.col("prev.conv_id").eqNullSafe(F.col("conv_id")), F.col("prev.id"))
    return prev.join(best, "id", "left").select("id", "conv_id", "turn", F.coalesce("quoted", before).alias("parent"),
                                                F.col("quoted").isNotNull().alias("linked"))


def depths(tree: DataFrame) -> DataFrame:
    """``id, root, depth`` by pointer doubling: rounds grow with the logarithm of the longest chain, and
    only messages that have not found their root take part in the next one."""
    active = cut(tree.select("id", F.coalesce("parent", "id").alias("root"), F.col("parent").isNotNull().cast("long").alias("depth")))
    done = []
    while True:
        pointers = reduce(DataFrame.unionByName, [*done, active]).where("depth > 0") \
            .select(F.col("id").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        step = cut(active.join(pointers, "root", "left"))
        done.append(step.where("next is null").select("id", "root", "depth"))
        active = step.where("next is not null").select("id", F.col("next").alias("root"), (F.col("depth") + F.col("more")).alias("depth"))
        if active.isEmpty():
            return reduce(DataFrame.unionByName, done)


def threads(conversations: DataFrame) -> DataFrame:
    """All messages with the one they reply to, their tree, and their place in it."""
    spark = conversations.sparkSession
    m = messages(conversations)
    tree = cut(parents(m))
    placed = tree.join(depths(tree), "id")
    asc = ["root", "depth", "id"]
    ranged = cut(placed.repartitionByRange(parts_for(0, spark), *asc).withColumn("part", F.spark_partition_id()))
    per = ranged.groupBy("root", "part").agg(F.count("*").alias("n"))
    skip = per.select("root", "part", F.coalesce(F.sum("n").over(
        W.partitionBy("root").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("skip"))
    ranked = (ranged.withColumn("k", F.row_number().over(W.partitionBy("root", "part").orderBy("depth", "id"))).join(skip, ["root", "part"])
              .select("id", "parent", "linked", "root", "depth", (F.col("k") - 1 + F.col("skip")).alias("position")))
    name = lambda c: m.select(F.col("id").alias(c), F.col("conv_id").alias(f"{c}_conv"), F.col("turn").alias(f"{c}_turn"))
    own = body(F.col("text"))
    return (m.select("id", "conv_id", "turn", "role", own.alias("body")).join(ranked, "id")
            .join(name("parent"), "parent", "left").join(name("root"), "root")
            .select("conv_id", "turn", "role", F.col("parent_conv").alias("reply_conv"), F.col("parent_turn").alias("reply_turn"), "linked",
                    F.col("root_conv").alias("thread_conv"), F.col("root_turn").alias("thread_turn"), "depth", "position", "body",
                    F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("body"), F.lit("\n<|end|>\n")).alias("chat")))


def op8_chat_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages of ``conversations`` in reply order, without quotes."""
    return threads(table(spark, sf_dir, "conversations"))
