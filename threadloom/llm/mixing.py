"""Problem 2: sources mixed to target shares of the total size, with capped repetition."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.session import collect_bounded

UNIT = 1 << 52


def _source(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))


def records(turns: DataFrame) -> DataFrame:
    """Messages with text, read twice or not, once each: ``(turn_id, source, n_chars)``; ``turn_id`` is the smallest of a message."""
    t = turns.where("text is not null and length(text) > 0 and source is not null")
    t = t.select(_source(F.col("source")).alias("source"), F.coalesce(F.concat(F.lit("id:"), F.col("source_id")), F.concat(F.lit("turn:"), F.col("turn_id").cast("string"))).alias("message"), F.struct(F.col("turn_id").cast("bigint").alias("turn_id"), F.length("text").cast("bigint").alias("n")).alias("r"))
    return t.groupBy("source", "message").agg(F.min("r").alias("r")).select("r.turn_id", "source", F.col("r.n").alias("n_chars"))


def rates(available: dict[str, int], targets: dict[str, tuple[float, int]]) -> dict[str, float]:
    """How often each source's records are used on average.

    The total is the largest at which every source that has records reaches its
    share without exceeding its cap; a source without records is left out and the
    others keep their proportions.
    """
    live = {s: (p, k) for s, (p, k) in targets.items() if p > 0 and k > 0 and available.get(s, 0) > 0}
    if not live:
        return {}
    total = min(k * available[s] / p for s, (p, k) in live.items())
    return {s: min(float(k), p * total / available[s]) for s, (p, k) in live.items()}


def _targets(targets: DataFrame) -> dict[str, tuple[float, int]]:
    out: dict[str, tuple[float, int]] = {}
    rows = targets.where("source is not null").select(_source(F.col("source")).alias("s"), "target_share", "max_repeats")
    for r in collect_bounded(rows, 100_000):
        p, k = out.get(r["s"], (0.0, 0))
        out[r["s"]] = (p + float(r["target_share"] or 0), max(k, int(r["max_repeats"] or 0)))
    return out


def _plan(turns: DataFrame, targets: DataFrame):
    want = _targets(targets)
    rec = records(turns).where(F.col("source").isin(list(want)) if want else F.lit(False))
    have = {r["source"]: r["n"] for r in rec.groupBy("source").agg(F.sum("n_chars").alias("n")).collect()}  # at most a row per target
    return want, rec, have, rates(have, want)


def mix(turns: DataFrame, targets: DataFrame, seed: int = 0, with_text: bool = False) -> DataFrame:
    """The mixture, a row per use of a message: ``(turn_id, source, copy, n_chars)``, with ``text`` on request.

    A record is used floor(rate) times and once more if its seeded hash is below
    the rate's fraction, never more than ``max_repeats`` of its source.  Records
    without text or source, and sources that are no target, take no part; null or
    zero shares and caps give nothing.  Sources named twice in other spelling add up.
    """
    _, rec, _, rate = _plan(turns, targets)
    spark = turns.sparkSession
    plan = spark.createDataFrame([(s, math.floor(r), r - math.floor(r)) for s, r in sorted(rate.items())], "source string, whole int, part double")
    r = rec.join(F.broadcast(plan), "source")
    draw = F.pmod(F.xxhash64(F.lit(seed), "turn_id"), F.lit(UNIT)) / F.lit(float(UNIT))
    r = r.withColumn("n", F.col("whole") + (draw < F.col("part")).cast("int")).where("n > 0")
    out = r.select("turn_id", "source", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"), "n_chars")
    return out.join(turns.select(F.col("turn_id").cast("bigint").alias("turn_id"), "text"), "turn_id") if with_text else out


def mix_report(turns: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """Per target source: share wanted and reached, characters available and used, rate, records used and uses of the most used one."""
    want, _, have, rate = _plan(turns, targets)
    spark = turns.sparkSession
    plan = spark.createDataFrame([(s, p, k, have.get(s, 0), rate.get(s, 0.0)) for s, (p, k) in sorted(want.items())], "source string, target_share double, max_repeats bigint, chars_available bigint, rate double")
    m = mix(turns, targets, seed)
    used = m.groupBy("source").agg(F.sum("n_chars").alias("chars_used"), F.count_if(F.col("copy") == 1).alias("n_records"), F.count("*").alias("n_uses"), F.max("copy").cast("bigint").alias("most_uses"))
    total = used.agg(F.sum("chars_used").alias("total"))
    out = plan.join(used, "source", "left").join(F.broadcast(total), how="left").na.fill(0, ["chars_used", "n_records", "n_uses", "most_uses"])
    return out.withColumn("share", F.round(F.col("chars_used") / F.col("total"), 6)).drop("total").withColumn("rate", F.round("rate", 6))
