"""Envelopes to turns, splits, replies and volume."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.text import is_blank, source_key, thread_bucket, trim_u

HELDOUT_PERCENT = 15
QUARANTINE_WEEKS = 12
MAX_CONTEXT, MAX_GAP_MINUTES = 6, 180

# The payload field that names the thread, per source.
THREAD_FIELD = {
    "imessage": "chat_guid",
    "claude_code": "file",
    "claude_ai": "conversation_uuid",
    "perplexity": "context_uuid",
    "chatgpt": "conversation_id",
    "git_repos": "repo",
    "mail": "to",
}

Builder = Callable[[Column], dict[str, Column]]
_REGISTRY: dict[str, Builder] = {}


def register(source: str, builder: Builder) -> None:
    """Adds a source: a function from the payload map to the columns thread_key, author_id and is_subject."""
    _REGISTRY[source] = builder


def _one_sided(source: str) -> Builder:
    return lambda p: {"thread_key": p[THREAD_FIELD[source]], "author_id": F.col("subject_id"), "is_subject": F.lit(True)}


def _chat(p: Column) -> dict[str, Column]:
    mine = F.coalesce(F.lower(p["is_from_me"]).isin("true", "1"), F.lit(False))
    return {"thread_key": p["chat_guid"], "author_id": F.when(mine, F.col("subject_id")).otherwise(F.coalesce(p["handle"], F.lit("unknown"))), "is_subject": mine}


for _s in THREAD_FIELD:
    register(_s, _one_sided(_s))
register("imessage", _chat)


def thread_or_orphan(source: Column, source_id: Column, key: Column) -> Column:
    """The thread key, or an id of its own for a message whose key is missing, blank or ``unknown``."""
    return F.when(is_blank(key) | (trim_u(key) == "unknown"), F.concat_ws(":", source, F.lit("orphan"), source_id)).otherwise(key)


def normalize(envelopes: DataFrame) -> DataFrame:
    """Envelopes (payload as JSON text) to turns; blank messages are dropped, an unregistered source is an error.

    A payload that is no JSON object counts as empty and so is dropped.
    """
    e = envelopes.withColumn("source", source_key(F.col("source")))
    p = F.from_json("payload", "map<string,string>", {"allowSingleQuotes": "false"})
    e = e.withColumn("p", p)
    cols = {k: F.raise_error(F.concat(F.lit("no normalizer for source "), F.col("source"))).cast(t) for k, t in (("thread_key", "string"), ("author_id", "string"), ("is_subject", "boolean"))}
    for s, build in _REGISTRY.items():
        for k, c in build(F.col("p")).items():
            cols[k] = F.when(F.col("source") == s, c).otherwise(cols[k])
    text = trim_u(F.col("p")["text"])
    e = e.withColumns({**cols, "text": text}).where(~is_blank(F.col("text")))
    return e.select(
        "subject_id", "source", "source_id", thread_or_orphan(F.col("source"), F.col("source_id"), F.col("thread_key")).alias("thread_id"), "ts", "author_id", "is_subject", "text",
        F.lit(False).alias("assisted"), F.lit(None).cast("string").alias("corpus_version"), F.coalesce(F.lower(F.col("p")["looks_pasted"]) == "true", F.lit(False)).alias("looks_pasted"),
    )


def is_quarantined(ts: Column, now: Column, weeks: int = QUARANTINE_WEEKS) -> Column:
    """Younger than so many weeks; the boundary itself is not. Null for a null time."""
    return ts > now - F.make_interval(weeks=F.lit(weeks))


def split_name(thread: Column, ts: Column, now: Column, weeks: int = QUARANTINE_WEEKS, percent: int = HELDOUT_PERCENT) -> Column:
    """``quarantined`` if younger than ``weeks``, else ``heldout`` by the thread's bucket, else ``train``."""
    return F.when(is_quarantined(ts, now, weeks), "quarantined").when(thread_bucket(thread) < percent, "heldout").otherwise("train")


def split_corpus(turns: DataFrame, now: Column, weeks: int = QUARANTINE_WEEKS) -> DataFrame:
    """Turns with a ``split`` column; every turn is in exactly one split, null threads and times in train."""
    return turns.withColumn("split", split_name(F.col("thread_id"), F.col("ts"), now, weeks))


def split_counts(turns: DataFrame, now: Column, weeks: int = QUARANTINE_WEEKS) -> DataFrame:
    return split_corpus(turns, now, weeks).groupBy("split").agg(F.count("*").alias("n"))


def reply_pairs(turns: DataFrame, max_context: int = MAX_CONTEXT, max_gap_minutes: int = MAX_GAP_MINUTES) -> DataFrame:
    """Every turn of the subject with the up to ``max_context`` turns before it in its thread.

    The context keeps those not older than ``max_gap_minutes`` and must hold a turn
    of somebody else.  Order is by time, then source_id, then turn text; the frame
    is bounded, so a thread streams through its task and is never held as a whole.
    """
    gap = F.expr(f"INTERVAL {int(max_gap_minutes)} MINUTES")
    w = Window.partitionBy("thread_id").orderBy("ts", "source_id").rowsBetween(-max_context, -1)
    before = F.collect_list(F.struct("ts", "source_id", "author_id", "is_subject", "text")).over(w)
    t = turns.where("thread_id is not null and ts is not null").withColumn("before", before)
    t = t.where(F.coalesce("is_subject", F.lit(False))).withColumn("context", F.filter("before", lambda x: x["ts"] >= F.col("ts") - gap)).drop("before")
    return t.where(F.exists("context", lambda x: ~F.coalesce(x["is_subject"], F.lit(False))))


def volume(turns: DataFrame, per_million: float = 3.0) -> DataFrame:
    """Turns, the subject's turns, their characters, tokens at four characters each, and the cost of these."""
    mine = F.coalesce("is_subject", F.lit(False))
    chars = F.coalesce(F.sum(F.when(mine, F.length("text"))), F.lit(0))
    return turns.agg(F.count("*").alias("total_turns"), F.count_if(mine).alias("subject_turns"), chars.alias("subject_chars")).select(
        "*", F.expr("subject_chars div 4").alias("approx_tokens"), F.round(F.expr("subject_chars div 4") / 1e6 * per_million, 6).alias("cost")
    )


def by_source(turns: DataFrame) -> DataFrame:
    """The subject's turns per source, the largest first."""
    return turns.where("is_subject").groupBy(source_key(F.col("source")).alias("source")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source")


def golden_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Turns dropped, added, rewritten and kept from one version to the next, by (source, source_id)."""
    a = old.select("source", "source_id", F.col("text").alias("before"), F.lit(1).alias("a"))
    b = new.select("source", "source_id", F.col("text").alias("after"), F.lit(1).alias("b"))
    j = a.join(b, ["source", "source_id"], "full_outer")
    return j.agg(
        F.count_if(F.col("b").isNull()).alias("dropped"), F.count_if(F.col("a").isNull()).alias("added"),
        F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull() & ~F.col("before").eqNullSafe(F.col("after"))).alias("rewritten"),
        F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull() & F.col("before").eqNullSafe(F.col("after"))).alias("kept"),
    )


def vault_dedupe(envelopes: DataFrame, keys: tuple[str, ...] = ("subject_id", "source", "source_id"), order: tuple[str, ...] = ("ingested_at", "ts", "payload")) -> DataFrame:
    """First arrival of every key; a map-side combined minimum, so a key with many copies is one row per partition."""
    rest = [c for c in envelopes.columns if c not in keys]
    first = F.min(F.struct(*order, *[F.col(c).alias(f"_{c}") for c in rest]))
    return envelopes.groupBy(*keys).agg(first.alias("f")).select(*keys, *[F.col(f"f._{c}").alias(c) for c in rest])


def new_to_vault(batch: DataFrame, vault: DataFrame, keys: tuple[str, ...] = ("subject_id", "source", "source_id")) -> DataFrame:
    """The rows of a batch whose key the vault does not hold, first arrival of each."""
    return vault_dedupe(batch, keys).join(vault.select(*keys), list(keys), "left_anti")
