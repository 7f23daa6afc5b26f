"""Chat formatting by quotation linking (native: DataFrame expressions only).

Messages quote earlier ones in the way of mail, with one ``>`` for each level.  Quote levels
are parsed line by line; every maximal run of lines of one level is a passage.  Passages are
normalised and hashed, whole and by line, and looked up among the own passages of the
earlier messages of the thread; the latest earlier message wins.  What a message quotes at
its lowest level is what it replies to.  Pointer jumping over the reply links gives root and
depth, and the messages come out in reply order, without quotes.

The lookups are as-of joins by (thread, passage hash) in slices of ``SLICE`` turns with the
last hit of earlier slices carried over, so a line that a whole thread quotes never meets in
one task, and no pair of messages is built but the ones linked.

Defined cases: null text is empty; a null thread is a thread of its own; a null turn counts
as -1; repeated (thread, turn) rows are one message with several texts, each row kept; a
message whose quotes match nothing starts a thread of its own and still loses its quotes;
an empty table gives an empty result; clashing extra columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.llm.common import WS_CHARS, guarded, let, text_or_empty, unguarded, written

SLICE = 1024
MARKS = r"^[ \t]*(?:>[ \t]?)+"
#: a mail's line that announces a quote
ATTRIBUTION = r"(?i)^(on|am|le|el)\b.{0,200}\b(wrote|schrieb|écrit|escribió)\s*:\s*$"


def _lines(text: Column) -> Column:
    """Array of (level, content) of the lines of a text."""
    def parse(line):
        mark = F.regexp_extract(line, MARKS, 0)
        return F.struct((F.length(mark) - F.length(F.replace(mark, F.lit(">"), F.lit("")))).alias("level"),
                        F.when(mark == "", line).otherwise(F.substring(line, F.length(mark) + 1, F.length(line))).alias("content"))
    return F.transform(F.split(text_or_empty(text), "\n"), parse)


def own_text(lines: Column) -> Column:
    """The lines of level 0 without attributions that stand right above a quote, trimmed."""
    kept = let(lines, lambda a: F.filter(a, lambda e, i: (e["level"] == 0) & ~(
        (F.coalesce(F.get(a, i + 1)["level"], F.lit(0)) > 0) & e["content"].rlike(ATTRIBUTION))))
    return F.btrim(F.array_join(F.transform(kept, lambda e: e["content"]), "\n"), F.lit(WS_CHARS))


def _norm(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "), F.lit(" "))


def _hashed(text: Column, whole: bool) -> Column:
    return let(_norm(text), lambda n: F.when(n != "", F.struct(
        F.lit(whole).alias("whole"), F.xxhash64(n, F.lit(whole)).alias("h"), F.length(n).alias("chars"))))


def _quoted(lines: Column) -> Column:
    """Array of (level, text) of the runs of quoted lines of one level."""
    def of(a):
        new = F.filter(F.sequence(F.lit(0), F.size(a) - 1),
                       lambda i: (i == 0) | (F.get(a, i)["level"] != F.get(a, i - 1)["level"]))
        runs = let(new, lambda s: F.transform(s, lambda i, k: F.struct(
            F.get(a, i)["level"].alias("level"),
            F.array_join(F.transform(F.slice(a, i + 1, F.coalesce(F.get(s, k + 1), F.size(a)) - i), lambda e: e["content"]), "\n").alias("t"))))
        return F.filter(runs, lambda r: r["level"] > 0)
    return let(lines, of)


def _passage_rows(messages: DataFrame, text: str) -> DataFrame:
    """(thread, turn, level, whole, h, chars): own passages (level 0) and quoted ones, whole and line
    by line.  They are taken and hashed within the message, so no text is shuffled."""
    def hashed(level, t, whole):
        return let(_hashed(t, whole), lambda p: F.when(p.isNotNull(), F.struct(
            level.cast("int").alias("level"), p["whole"].alias("whole"), p["h"].alias("h"), p["chars"].alias("chars"))))

    def of(a):
        by_line = F.transform(a, lambda e: hashed(e["level"], e["content"], False))
        quoted = F.transform(_quoted(a), lambda r: hashed(r["level"], r["t"], True))
        own = F.array(hashed(F.lit(0), own_text(a), True))
        return F.array_distinct(F.concat(by_line, quoted, own))
    found = let(_lines(F.col(text)), of)
    return messages.select("_thread", "_turn", F.explode(found).alias("p")).filter(F.col("p").isNotNull()) \
                   .select("_thread", "_turn", "p.*").distinct()


def reply_links(passages: DataFrame) -> DataFrame:
    """(thread, turn, reply_to, level): what each message replies to."""
    p = passages.withColumn("slice", F.floor(F.col("_turn") / SLICE))
    origin = p.filter("level = 0").select("_thread", "h", "whole", "slice", "_turn").distinct()
    quote = p.filter("level > 0")
    sliced = (origin.groupBy("_thread", "h", "whole", "slice").agg(F.max("_turn").alias("last"))
              .unionByName(quote.select("_thread", "h", "whole", "slice", F.lit(None).cast("long").alias("last")).distinct())
              .groupBy("_thread", "h", "whole", "slice").agg(F.max("last").alias("last")))
    before = Window.partitionBy("_thread", "h", "whole").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = sliced.withColumn("carried", F.max("last").over(before)).drop("last")
    # within a slice: at most SLICE turns of originals and quotes each
    earlier = Window.partitionBy("_thread", "h", "whole", "slice").orderBy("_turn").rangeBetween(Window.unboundedPreceding, -1)
    both = (origin.withColumn("from", F.col("_turn")).withColumn("q", F.lit(None).cast("struct<level:int,chars:int>"))
            .unionByName(quote.select("_thread", "h", "whole", "slice", "_turn", F.lit(None).cast("long").alias("from"),
                                      F.struct(F.col("level").cast("int").alias("level"), F.col("chars").cast("int").alias("chars")).alias("q"))))
    found = (both.withColumn("near", F.max("from").over(earlier)).filter(F.col("q").isNotNull())
             .join(carried, ["_thread", "h", "whole", "slice"])
             .withColumn("reply_to", F.coalesce("near", "carried")).filter(F.col("reply_to").isNotNull()))
    # one candidate's passages add up; the lowest level, then whole passages, then more text, then the later message
    votes = found.groupBy("_thread", "_turn", "q.level", "reply_to").agg(
        F.max("whole").alias("whole"), F.sum("q.chars").alias("chars"))
    return votes.groupBy("_thread", "_turn").agg(
        F.max(F.struct((-F.col("level")).alias("level"), "whole", "chars", "reply_to")).alias("b")).select("_thread", "_turn", "b.reply_to")


def reply_trees(links: DataFrame) -> DataFrame:
    """(thread, turn, reply_to, root, depth) for every linked message, by pointer jumping: the
    distance to ``root`` doubles every round, and messages that have arrived drop out."""
    state = written(links.select("_thread", "_turn", "reply_to", F.col("reply_to").alias("root"), F.lit(1).cast("long").alias("depth"),
                                 F.lit(True).alias("open")), "replies")
    while state.filter("open").limit(1).count():
        up = state.select(F.col("_thread").alias("u_thread"), F.col("_turn").alias("u_turn"), F.col("root").alias("u_root"),
                          F.col("depth").alias("u_depth"))
        jumped = (state.filter("open").join(up, (F.col("_thread") == F.col("u_thread")) & (F.col("root") == F.col("u_turn")), "left")
                  .select("_thread", "_turn", "reply_to", F.coalesce("u_root", "root").alias("root"),
                          (F.col("depth") + F.coalesce("u_depth", F.lit(0))).alias("depth"), F.col("u_root").isNotNull().alias("open")))
        state = written(jumped.unionByName(state.filter("NOT open")), "replies")
    return state.drop("open")


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with the row number (from 0) of each row in its group.

    Rows are dealt out by range over (group, order), so a large group spans many tasks; the
    sizes of the tasks (one row each) give the offsets.
    """
    dealt = written(df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                    .withColumn("_part", F.spark_partition_id())
                    .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "numbered")
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("n"))
    offset = sizes.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_offset"))
    # one row for each task of the stage above
    whole = dealt.join(F.broadcast(offset), "_part").withColumn("_at", F.col("_at") + F.col("_offset"))
    first = whole.groupBy(group).agg(F.min("_at").alias("_first"))
    return whole.join(first, group).withColumn(name, F.col("_at") - F.col("_first")).drop("_part", "_at", "_offset", "_first")


def conversations(messages: DataFrame, thread: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """Every row of ``messages`` with its text freed of quotes and with reply_to, thread_root,
    depth, n_quoted_lines and position (reply order within the thread: root, depth, turn)."""
    out = ["reply_to", "thread_root", "depth", "n_quoted_lines", "position"]
    base = (guarded(messages, [thread, turn, text], out)
            .withColumn("_thread", F.coalesce(F.col(thread).cast("string"), F.lit("\0null")))
            .withColumn("_turn", F.coalesce(F.col(turn).cast("long"), F.lit(-1).cast("long")))
            .withColumn("_row", F.xxhash64(F.col(text))))
    parsed = written(base, "messages")
    trees = reply_trees(reply_links(written(_passage_rows(parsed, text), "passages")))
    lines = let(_lines(F.col(text)), lambda a: F.struct(
        own_text(a).alias("own"), F.size(F.filter(a, lambda e: e["level"] > 0)).cast("long").alias("quoted")))
    joined = (parsed.withColumn("_l", lines).withColumn("n_quoted_lines", F.col("_l.quoted")).withColumn(text, F.col("_l.own"))
              .drop("_l").join(trees, ["_thread", "_turn"], "left")
              .withColumn("thread_root", F.coalesce("root", "_turn"))
              .withColumn("depth", F.coalesce("depth", F.lit(0).cast("long"))).drop("root"))
    done = numbered(joined, "_thread", ["thread_root", "depth", "_turn", "_row"], "position")
    return unguarded(done, messages.columns, [thread, turn, text], out)


def mail_view(conversations: DataFrame) -> DataFrame:
    """Replies in the way of mail, derived from a chat without quotes: each message is followed
    by the message before it as a quote, and by the one before that as a quote in the quote."""
    def earlier(by, name):
        return (conversations.groupBy("conv_id", (F.col("turn") + by).alias("turn")).agg(F.min("text").alias(name)))

    def marked(column, mark):
        return F.array_join(F.transform(F.split(column, "\n"), lambda x: F.concat(F.lit(mark), x)), "\n")
    return (conversations.join(earlier(1, "_one"), ["conv_id", "turn"], "left").join(earlier(2, "_two"), ["conv_id", "turn"], "left")
            .withColumn("text", F.concat_ws("\n", "text", marked(F.col("_one"), "> "), marked(F.col("_two"), "> > ")))
            .drop("_one", "_two"))
