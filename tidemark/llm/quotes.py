"""Chat formatting by quotation linking.

Lines of a message that begin with ``>`` marks are quotes; the number of marks is their level. Consecutive lines of one
level form a passage. Quoted passages, and each of their lines, are normalised and hashed, and joined to the messages
that hold the same passage or line unquoted. A message's parent is the earlier message of its conversation that it
quotes; parents make reply threads, and each thread becomes a conversation: its messages in reply order, without quotes.

Scale: only hashes that some quote asks for are joined. The search for the latest earlier original runs in buckets of
``SPAN`` turns with a running maximum over buckets, so neither a conversation nor a passage that holds a third of all
rows meets in one task; threads are followed by pointer doubling over linked messages; a thread is put together in
parts of ``SPAN`` turns, so none is collected whole. All DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.located import integer_ids
from tidemark.llm.scratch import Scratch

SPAN = 512
MARKS = r"^([ \t]*>)+[ \t]?"


def normalised(text: Column) -> Column:
    """ASCII lower case, runs of white space as one space, none at the ends."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(F.regexp_replace(low, r"[ \t\n\r\x0b\f]+", " "), "^ | $", "")


def parsed(messages: DataFrame) -> DataFrame:
    """Adds lines (level, body), runs (level, text of consecutive lines of one level) and reply (the level-0 text)."""
    lines = F.transform(
        F.split(F.regexp_replace(F.coalesce("text", F.lit("")), "\r\n?", "\n"), "\n"),
        lambda x: F.struct(F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), r"[ \t]", "")).alias("level"), F.regexp_replace(x, MARKS, "").alias("body")),
    )
    out = messages.withColumn("lines", lines)
    starts = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: (i == 0) | (F.col("lines")[i]["level"] != F.col("lines")[F.greatest(i - 1, F.lit(0))]["level"]))
    out = out.withColumn("starts", starts)
    runs = F.transform("starts", lambda s, k: F.struct(
        F.col("lines")[s]["level"].alias("level"),
        F.array_join(F.transform(F.slice("lines", s + 1, F.coalesce(F.try_element_at("starts", k + 2), F.size("lines")) - s), lambda x: x["body"]), "\n").alias("text"),
    ))
    reply = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"]), "\n")
    return out.withColumn("runs", runs).withColumn("reply", F.regexp_replace(reply, r"^[ \t\n\r\x0b\f]+|[ \t\n\r\x0b\f]+$", "")).drop("starts")


def latest_before(originals: DataFrame, asked: DataFrame) -> DataFrame:
    """For each of ``asked`` (conv, hash, turn), ``found``: the latest turn of ``originals`` before it, or null."""
    rows = originals.select("conv", "hash", "turn", F.col("turn").alias("has")).unionByName(asked.select("conv", "hash", "turn", F.lit(None).cast("long").alias("has")))
    rows = rows.withColumn("bucket", F.floor(F.col("turn") / SPAN))
    near = Window.partitionBy("conv", "hash", "bucket").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("near", F.max("has").over(near)).where("has is null")
    a_bucket = rows.groupBy("conv", "hash", "bucket").agg(F.max("has").alias("most"))
    carry = a_bucket.withColumn("carry", F.max("most").over(Window.partitionBy("conv", "hash").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    return inside.join(carry.select("conv", "hash", "bucket", "carry"), ["conv", "hash", "bucket"]).select("conv", "hash", "turn", F.coalesce("near", "carry").alias("found"))


def threads(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, turn, root, depth) of linked messages from ``parents`` (conv, turn, up), by pointer doubling."""
    step = 0
    at = scratch.save(parents.select("conv", "turn", "up", F.lit(1).cast("long").alias("depth")), "thread_0")
    while True:
        over = at.select("conv", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        if at.join(over, ["conv", "up"], "left_semi").isEmpty():
            return at.select("conv", "turn", F.col("up").alias("root"), "depth")
        step += 1
        at = scratch.save(at.join(over, ["conv", "up"], "left").select("conv", "turn", F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), f"thread_{step}")


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", role_col: str = "role") -> DataFrame:
    """One row a message, to be read in the order (conv_id, thread_turn, turn): its reply and its links.

    Columns: conv_id, turn, role, reply (the text without quotes and outer white space), n_quotes (quoted passages that
    aren't blank), max_level, n_linked (of those, with an original), parent_turn (in the conversation, null without),
    thread_turn (the root of its thread; its own turn without parent), depth, source_conv and source_turn (the original
    of its first choice, also from another conversation).

    An original of a passage is the latest earlier message of the conversation that holds the passage, or one of its
    lines, unquoted; without one, the message of least (conv_id, turn) anywhere that does, other than the message
    itself. Of a message's links the lowest quote level counts first, then the conversation's own, then the longest
    normalised text, then the latest turn. Null and empty texts have an empty reply and no quotes. Messages without
    conv_id or turn keep their reply and have no links. Messages that repeat (conv_id, turn) are one node: they share
    links, and a passage that both hold at one place counts once. conv_id and turn are integers; other types are refused.
    Other columns are ignored.
    """
    integer_ids(messages, conv_col)
    integer_ids(messages, turn_col)
    scratch = Scratch(messages.sparkSession, "quotes")
    base = messages.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    rows = parsed(base)
    placed = rows.where("conv is not null and turn is not null")
    key = lambda text: F.md5(text.cast("binary"))

    quoted = placed.select("conv", "turn", F.posexplode(F.filter("runs", lambda r: r["level"] > 0)).alias("at", "run")).select("conv", "turn", "at", F.col("run.level").alias("level"), F.col("run.text").alias("text"))
    quoted = quoted.where(normalised(F.col("text")) != "").withColumn("at", key(F.concat_ws(":", "at", "level", "text"))).distinct()
    quoted = scratch.save(quoted, "quoted")
    pieces = quoted.select("conv", "turn", "at", "level", F.explode(F.array_distinct(F.concat(F.array("text"), F.split("text", "\n")))).alias("piece"))
    pieces = pieces.withColumn("norm", normalised(F.col("piece"))).where("norm <> ''")
    pieces = scratch.save(pieces.select("conv", "turn", "at", "level", key(F.col("norm")).alias("hash"), F.length("norm").alias("n")).distinct(), "pieces")

    own = placed.select("conv", "turn", F.explode(F.array_distinct(F.concat(
        F.array("reply"), F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: r["text"]), F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"])
    ))).alias("piece"))
    own = own.withColumn("norm", normalised(F.col("piece"))).where("norm <> ''").select("conv", "turn", key(F.col("norm")).alias("hash"))
    own = scratch.save(own.join(pieces.select("hash").distinct(), "hash", "left_semi").distinct(), "originals")

    here = latest_before(own, pieces.select("conv", "hash", "turn").distinct())
    anywhere = own.groupBy("hash").agg(F.min(F.struct("conv", "turn")).alias("first"))
    met = pieces.join(here, ["conv", "hash", "turn"], "left").join(anywhere, "hash", "left")
    other = F.when(~((F.col("first.conv") == F.col("conv")) & (F.col("first.turn") == F.col("turn"))), F.col("first"))
    met = met.withColumn("own", F.col("found").isNotNull()).withColumn("source", F.when(F.col("own"), F.struct(F.col("conv"), F.col("found").alias("turn"))).otherwise(other)).where("source is not null")
    choice = F.struct((-F.col("level")).alias("l"), F.col("own").alias("o"), F.col("n").alias("n"), F.col("source.turn").alias("t"), F.col("source.conv").alias("c"))
    linked = met.groupBy("conv", "turn").agg(F.countDistinct("at").alias("n_linked"), F.max(choice).alias("best"), F.max(F.when(F.col("own"), choice)).alias("kin"))
    linked = scratch.save(linked.select("conv", "turn", "n_linked", F.col("best.c").alias("source_conv"), F.col("best.t").alias("source_turn"), F.col("kin.t").alias("up")), "linked")
    thread = threads(linked.where("up is not null").select("conv", "turn", "up"), scratch)
    counts = quoted.groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("n_quotes"), F.max("level").alias("max_level"))
    nodes = counts.join(linked, ["conv", "turn"], "left").join(thread, ["conv", "turn"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return rows.select("conv", "turn", "role", "reply").join(nodes, ["conv", "turn"], "left").select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), "reply", zero("n_quotes"), zero("max_level"), zero("n_linked"),
        F.col("up").alias("parent_turn"), F.coalesce("root", "turn").alias("thread_turn"), zero("depth"), "source_conv", "source_turn",
    )


def reply_ordered(links: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role") -> DataFrame:
    """Conversations from the rows of ``link_quotes``: one row a thread and part of it.

    Columns: conv_id, thread_turn (the thread's first message), part (of ``SPAN`` turns, from 0), messages (an array of
    (turn, role, reply, parent_turn, depth, n_quotes, n_linked, source_conv, source_turn, copies) in the order of turn,
    role and reply), n_messages. Read by (conv_id, thread_turn, part) the rows are the reply-ordered conversation. Equal
    messages of one place are one element with their number in copies, so a row holds ``SPAN`` turns and what different
    texts stand on one turn. A message without conv_id or turn is a conversation by itself, with part null.
    """
    fields = ("parent_turn", "depth", "n_quotes", "n_linked", "source_conv", "source_turn")
    rows = links.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), "thread_turn", F.coalesce(role_col, F.lit("")).alias("role"), "reply", *fields)
    placed = rows.where("conv_id is not null and turn is not null")
    message = F.struct("turn", "role", "reply", *fields, "copies")
    once = placed.groupBy("conv_id", "thread_turn", "turn", "role", "reply", *fields).agg(F.count(F.lit(1)).alias("copies"))
    parts_ = once.groupBy("conv_id", "thread_turn", (F.floor(F.col("turn") / SPAN) - F.floor(F.col("thread_turn") / SPAN)).alias("part")).agg(F.array_sort(F.collect_list(message)).alias("messages"), F.sum("copies").alias("n_messages"))
    lone = rows.where("conv_id is null or turn is null").withColumn("copies", F.lit(1).cast("long"))
    return parts_.unionByName(lone.select("conv_id", "thread_turn", F.lit(None).cast("long").alias("part"), F.array(message).alias("messages"), F.col("copies").alias("n_messages")))


def quoting(conversations: DataFrame) -> DataFrame:
    """``conversations`` with quotes, by fixed rules; the table itself quotes nothing.

    md5(conv_id:turn) mod 8 chooses what stands before a text: 0 nothing; 1 the message before, quoted; 2 the two before
    at two levels; 3 (after the text) the message before in capitals with double spaces; 4 the first message of the next
    conversation; 5 a passage that stands nowhere; 6 the first line of the message before; 7 the second message before,
    at two levels. A quote of a message that doesn't exist is left out.
    """
    own = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    one = own.groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    back = lambda n: one.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("text").alias(f"back{n}"))
    start = one.where("turn = 0").select((F.col("conv_id") - 1).alias("conv_id"), F.col("text").alias("other"))
    rows = own.join(back(1), ["conv_id", "turn"], "left").join(back(2), ["conv_id", "turn"], "left").join(start, "conv_id", "left")
    number = F.conv(F.substring(F.md5(F.concat_ws(":", "conv_id", "turn").cast("binary")), 1, 6), 16, 10).cast("long") % 8
    quote = lambda text, mark: F.concat(F.lit(mark), F.replace(text, F.lit("\n"), F.lit("\n" + mark)))
    before, second, text = F.col("back1"), F.col("back2"), F.col("text")
    loud = F.replace(F.translate(before, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.lit(" "), F.lit("  "))
    lines = {
        1: [quote(before, "> "), text], 2: [quote(second, ">> "), quote(before, "> "), text], 3: [text, quote(loud, ">")], 4: [quote(F.col("other"), "> "), text],
        5: [F.concat(F.lit("> never said "), F.md5(text.cast("binary"))), text], 6: [quote(F.split(before, "\n")[0], "> "), text], 7: [quote(second, "> > "), text],
    }
    made = text
    for n, parts_ in lines.items():
        made = F.when(number == n, F.concat_ws("\n", *parts_)).otherwise(made)
    return rows.select("conv_id", "turn", "role", made.alias("text"))


def op1_quote_linking(spark, sf_dir: str) -> DataFrame:
    """All ``conversations``, made to quote by fixed rules, as reply-ordered conversations without quotes.

    A row is a part of a thread: its messages as text and, of each message, its turn, parent, source and links.
    """
    made = Scratch(spark, "quoting").save(quoting(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "conversations")
    found = reply_ordered(link_quotes(made))
    texts = lambda *cs, sep: F.array_join(F.transform("messages", lambda m: F.concat_ws(":", *(F.coalesce(m[c].cast("string"), F.lit("")) for c in cs))), sep)
    total = lambda c: F.aggregate("messages", F.lit(0).cast("long"), lambda s, m: s + m[c] * m["copies"])
    return found.select(
        "conv_id", "thread_turn", "part", "n_messages", total("n_quotes").alias("n_quotes"), total("n_linked").alias("n_linked"),
        F.array_max(F.transform("messages", lambda m: m["depth"])).alias("max_depth"), texts("turn", "parent_turn", "source_conv", "source_turn", sep=" ").alias("links"), texts("role", "reply", sep="\n\n").alias("dialogue"),
    )
