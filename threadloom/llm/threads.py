"""Problem 7: conversations rebuilt from message rows, and the threads that are broken, empty or one-sided."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.session import Stage

# Per source the payload's thread field, parent field, speaker field and the value that names the subject.
FIELDS = {
    "imessage": ("chat_guid", "thread_originator", "is_from_me", "true"),
    "claude_ai": ("conversation_uuid", "parent_message_uuid", "sender", "human"),
    "chatgpt": ("conversation_id", "parent", "role", "user"),
}
# Characters that show nothing: white space, controls, format characters, fillers, variation selectors, the object placeholder.
UNSEEN = r"[\s\p{Z}\p{Cc}\p{Cf}\x{034F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{2800}\x{3164}\x{FE00}-\x{FE0F}\x{FFA0}\x{FFFC}]"


def _source() -> Column:
    return F.lower(F.regexp_replace("source", r"(?U)^\s+|\s+$", ""))


def has_text(c: Column) -> Column:
    """Whether a text shows anything; false for null."""
    return F.coalesce(F.length(F.regexp_replace(c, UNSEEN, "")) > 0, F.lit(False))


def json_object(c: Column) -> Column:
    """The fields of a JSON object as strings; null for anything else, trailing text and single quotes included."""
    one = F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<map<string,string>>", {"allowSingleQuotes": "false"})
    return F.when(c.rlike(r"^\s*\{[\s\S]*\}\s*$") & (F.size(one) == 1), one[0])


def _per_source(i: int) -> Column:
    out = F.lit(None).cast("string")
    for s, f in FIELDS.items():
        out = F.when(F.col("source") == s, F.col("o")[f[i]]).otherwise(out)
    return out


def messages(turns: DataFrame, envelopes: DataFrame) -> DataFrame:
    """One row per turn and per envelope with the thread it belongs to.

    An envelope belongs to the threads of the turns with its (source, source_id),
    else to the thread its payload names.  Columns: thread_id, source, source_id,
    id (hash of the three), parent, is_subject, has_text, damaged, is_turn, ts,
    author, text.
    """
    ours = list(FIELDS)
    t = turns.withColumn("source", _source()).where(F.col("source").isin(ours) & F.col("thread_id").isNotNull())
    e = envelopes.withColumn("source", _source()).where(F.col("source").isin(ours)).withColumn("o", json_object(F.col("payload")))
    subject = F.lit(False)
    for s, f in FIELDS.items():
        subject = F.when(F.col("source") == s, F.coalesce(F.lower(F.col("o")[f[2]]) == f[3], F.lit(False))).otherwise(subject)
    e = e.select(
        "source", "source_id", _per_source(0).alias("named"), F.when(_per_source(1) != "", _per_source(1)).alias("parent"), subject.alias("is_subject"),
        has_text(F.col("o")["text"]).alias("has_text"), F.col("o").isNull().alias("damaged"), F.lit(False).alias("is_turn"), "ts",
        F.when(F.col("source") == "imessage", F.col("o")["handle"]).otherwise(_per_source(2)).alias("author"), F.col("o")["text"].alias("text"),
    )
    at = t.where("source_id is not null").select("source", "source_id", "thread_id").distinct()
    e = e.join(at, ["source", "source_id"], "left").withColumn("thread_id", F.coalesce("thread_id", "named")).where("thread_id is not null").drop("named")
    t = t.select(
        "source", "source_id", F.lit(None).cast("string").alias("parent"), F.coalesce("is_subject", F.lit(False)).alias("is_subject"), has_text(F.col("text")).alias("has_text"),
        F.lit(False).alias("damaged"), F.lit(True).alias("is_turn"), "ts", F.col("author_id").alias("author"), "text", "thread_id",
    )
    return e.unionByName(t).withColumn("id", F.xxhash64("thread_id", "source", "source_id"))


def pointers(m: DataFrame) -> Stage:
    """``(id, thread_id, latest, p, orphan)`` of every message.

    A message read more than once may name several parents: it is an orphan if any
    of them is not a message of the thread, and ``p`` is one of those that are, the
    one of least hash, or null.
    """
    parents = m.where("parent is not null").select("id", F.xxhash64("thread_id", "source", "parent").alias("p")).distinct()
    known = m.select(F.col("id").alias("p")).distinct().withColumn("known", F.lit(True))
    parents = parents.join(known, "p", "left").groupBy("id").agg(F.min(F.when(F.col("known"), F.col("p"))).alias("p"), F.max(F.col("known").isNull()).alias("orphan"))
    own = m.groupBy("id").agg(F.first("thread_id").alias("thread_id"), F.min("ts").alias("latest"))
    return Stage(own.join(parents, "id", "left").select("id", "thread_id", "latest", "p", F.coalesce("orphan", F.lit(False)).alias("orphan")), "pointers")


def _rounds(first: DataFrame) -> int:
    """Doublings that reach across the longest thread."""
    return math.ceil(math.log2((first.groupBy("thread_id").count().agg(F.max("count")).first()[0] or 1) + 1)) + 1


def resolve(m: DataFrame) -> DataFrame:
    """Depth and latest ancestor time of every message, by pointer jumping.

    ``(id, thread_id, orphan, cycle, depth, latest)``: orphan if a parent it names is
    not a message of the thread, cycle if its parents never end.  Each round a pointer
    jumps to where its target points, so a chain of n messages takes log2(n) joins.
    """
    first = pointers(m)
    # settled: reached a root; open: still pointing somewhere
    done = first.df.where("p is null").select("id", "thread_id", "orphan", F.lit(False).alias("cycle"), F.lit(0).alias("depth"), "latest")
    state = Stage(first.df.select("id", "p", F.when(F.col("p").isNull(), 0).otherwise(1).alias("depth"), "latest"), "jump")
    for _ in range(_rounds(first.df)):
        if not state.df.where("p is not null").head(1):
            break
        to = state.df.select(F.col("id").alias("p"), F.col("p").alias("p2"), F.col("depth").alias("d2"), F.col("latest").alias("l2"))
        nxt = state.df.where("p is not null").join(to, "p").select("id", F.col("p2").alias("p"), (F.col("depth") + F.col("d2")).alias("depth"), F.greatest("latest", "l2").alias("latest"))
        new = Stage(state.df.where("p is null").unionByName(nxt), "jump")
        state.drop()
        state = new
    open_ = first.df.where("p is not null").select("id", "thread_id", "orphan").join(state.df, "id")
    return done.unionByName(open_.withColumn("cycle", F.col("p").isNotNull()).select("id", "thread_id", "orphan", "cycle", "depth", "latest"))


def paths(turns: DataFrame, envelopes: DataFrame) -> DataFrame:
    """Every way from a message without replies up to its root, in kept threads: ``(thread_id, leaf, seq, source, source_id)``.

    ``leaf`` is the source_id at the end of the path, ``seq`` counts from the root
    (1).  A branched thread has a path per branch, and what comes before the
    branching is in each; a message that neither answers nor is answered is a path
    of its own; messages whose parents form a cycle are in none.  Steps of 1, 2, 4, ...
    ancestors are joined from the widest down, so a chain of n takes log2(n) joins.
    """
    m = Stage(messages(turns, envelopes).drop("text", "author"), "messages")
    r = Stage(resolve(m.df), "resolved")
    kept = _verdicts(m.df, r.df).where("not dropped").select("thread_id")
    first = pointers(m.df)
    ok = r.df.where("not cycle").join(kept, "thread_id", "left_semi").select("id", "depth")
    step = first.df.where("p is not null").select("id", "p")
    leaves = ok.join(step.select(F.col("p").alias("id")).distinct(), "id", "left_anti")
    deepest = leaves.agg(F.max("depth")).first()[0] or 0
    steps = [Stage(step.join(ok.select("id"), "id", "left_semi"), "steps")]
    while 2 ** len(steps) <= deepest:
        d = steps[-1].df
        steps.append(Stage(d.join(d.select(F.col("id").alias("p"), F.col("p").alias("q")), "p").select("id", F.col("q").alias("p")), "steps"))
    at = leaves.select(F.col("id").alias("leaf"), "id", F.col("depth").alias("above"))
    for k in range(len(steps) - 1, -1, -1):
        up = at.join(steps[k].df, "id").select("leaf", F.col("p").alias("id"), (F.col("above") - 2**k).alias("above"))
        at = at.unionByName(up)
    name = m.df.groupBy("id").agg(F.first("thread_id").alias("thread_id"), F.first("source").alias("source"), F.first("source_id").alias("source_id"))
    end = name.select(F.col("id").alias("leaf"), F.col("source_id").alias("leaf_id"))
    return at.join(name, "id").join(end, "leaf").select("thread_id", F.col("leaf_id").alias("leaf"), (F.col("above") + 1).alias("seq"), "source", "source_id")


def _verdicts(m: DataFrame, pointers: DataFrame) -> DataFrame:
    both = m.groupBy("thread_id").agg(
        F.max("is_turn").alias("stored"),
        F.max("damaged").alias("damaged"),
        F.max(F.col("is_subject") & F.col("has_text")).alias("subject_speaks"),
        F.max(~F.col("is_subject") & F.col("has_text")).alias("others_speak"),
        F.countDistinct("id").alias("n_messages"),
    )
    p = pointers.groupBy("thread_id").agg(F.sum(F.col("orphan").cast("bigint")).alias("n_orphans"), F.sum(F.col("cycle").cast("bigint")).alias("n_cyclic"))
    v = both.where("stored").join(p, "thread_id", "left").na.fill(0, ["n_orphans", "n_cyclic"])
    return v.withColumn("dropped", F.col("damaged") | (F.col("n_orphans") > 0) | ~F.col("subject_speaks") | ~F.col("others_speak")).drop("stored")


def thread_verdicts(turns: DataFrame, envelopes: DataFrame) -> DataFrame:
    """One row per thread of the three sources: why it is dropped, or that it is kept.

    Dropped: an envelope's payload is not a JSON object, a parent that any copy of a
    message names is not a message of the thread, or the subject or everybody else has no message with
    text.  A cycle of parents is counted (``n_cyclic``) and does not drop a thread:
    its messages are ordered by time.  Turns without thread id and other sources
    take no part; empty tables give no rows.
    """
    m = Stage(messages(turns, envelopes).drop("text", "author"), "messages").df
    return _verdicts(m, resolve(m))


def conversations(turns: DataFrame, envelopes: DataFrame) -> DataFrame:
    """Every kept thread as one ordered conversation, a row per message.

    Columns: thread_id, seq (from 1), role (subject, assistant or other), author,
    ts, depth (parents above it), text, source, source_id.  A parent comes before
    its replies even if clocks disagree: order is by the latest time on the way
    from the root, then depth, time and source_id.  A message read twice comes
    once.  ``seq`` adds a rank within the day to the count of earlier days, so a
    thread of any length is never sorted in one task.
    """
    m = Stage(messages(turns, envelopes), "messages").df
    narrow = m.drop("text", "author")
    p = Stage(resolve(narrow), "resolved").df
    kept = _verdicts(narrow, p).where("not dropped").select("thread_id")
    one = m.groupBy("id").agg(
        F.first("thread_id").alias("thread_id"), F.first("source").alias("source"), F.first("source_id").alias("source_id"), F.min("ts").alias("ts"),
        F.max("is_subject").alias("is_subject"), F.max(F.when(F.col("author") != "unknown", F.col("author"))).alias("author"), F.max("text").alias("text"),
    )
    one = one.join(kept, "thread_id", "left_semi").join(p.select("id", "depth", "latest", "cycle"), "id")
    one = one.withColumn("latest", F.when(F.col("cycle"), F.col("ts")).otherwise(F.col("latest"))).withColumn("day", F.coalesce(F.to_date("latest"), F.to_date(F.lit("0001-01-01"))))
    days = one.groupBy("thread_id", "day").count()
    days = days.withColumn("before", F.coalesce(F.sum("count").over(Window.partitionBy("thread_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    rank = F.row_number().over(Window.partitionBy("thread_id", "day").orderBy("latest", "depth", "ts", "source", "source_id"))
    one = one.withColumn("r", rank).join(days, ["thread_id", "day"])
    role = F.when(F.col("is_subject"), "subject").when(F.col("source") == "imessage", "other").otherwise("assistant")
    return one.select("thread_id", (F.col("before") + F.col("r")).alias("seq"), role.alias("role"), "author", "ts", "depth", "text", "source", "source_id")
