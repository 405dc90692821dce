"""Style measures: fingerprints, distances between them, and bootstrap bands."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.text import FUNCTION_WORDS, n_punctuation, n_symbols, n_upper, words
from threadloom.session import Stage

SCALARS = ("mean_len", "median_len", "len_stdev", "burstiness", "punct_rate", "emoji_rate", "upper_rate", "type_token_ratio")
FIELDS = SCALARS + tuple(f"fw:{w}" for w in FUNCTION_WORDS)
MIN_SIDE = 4


def measured(texts: DataFrame, text: str = "text") -> DataFrame:
    """Adds what a fingerprint needs of every text, taken once: ``_len``, ``_punct``, ``_e``, ``_u`` and its ``_words``; null texts count as empty."""
    t = texts.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    c = F.col(text)
    return t.withColumns({"_len": F.length(c), "_punct": n_punctuation(c), "_e": n_symbols(c), "_u": n_upper(c), "_words": words(c)})


def fingerprint(texts: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """One row per group of ``keys`` with the measures of its texts; words are taken text by text.

    Null texts count as empty; a group without characters has rates of 0, one
    without words a ratio of 0.  The median is the exact interpolated one.
    """
    return _fingerprint(measured(texts, text), *keys)


def _fingerprint(t: DataFrame, *keys: str) -> DataFrame:
    keys_ = [F.col(k) for k in keys]
    size = F.greatest(F.sum("_len"), F.lit(1))
    a = t.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg("_len").alias("mean_len"), F.median("_len").alias("median_len"), F.coalesce(F.stddev_pop("_len"), F.lit(0.0)).alias("len_stdev"),
        (F.sum("_punct") / size).alias("punct_rate"), (F.sum("_e") / size).alias("emoji_rate"), (F.sum("_u") / size).alias("upper_rate"),
    )
    a = a.withColumn("burstiness", F.when(F.col("mean_len") > 0, F.col("len_stdev") / F.col("mean_len")).otherwise(0.0))
    w = t.select(*keys_, F.explode("_words").alias("_w")).groupBy(*keys, "_w").agg(F.count("*").alias("_n"))
    total = F.greatest(F.coalesce(F.sum("_n"), F.lit(0)), F.lit(1))
    w = w.groupBy(*keys).agg((F.count("*") / total).alias("type_token_ratio"), *[(F.coalesce(F.sum(F.when(F.col("_w") == x, F.col("_n"))), F.lit(0)) / total).alias(f"fw:{x}") for x in FUNCTION_WORDS])
    if keys:
        on = [a[k].eqNullSafe(w[k]) for k in keys]
        j = a.join(w, on, "left").select(*[a[c] for c in a.columns], *[w[f"`{c}`"] for c in w.columns if c not in keys])
    else:
        j = a.join(w, how="left")
    return j.select(*keys, "n", *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(c) for c in FIELDS])


def distance(a: dict[str, Column], b: dict[str, Column], scales: dict[str, Column]) -> Column:
    """Sum over all fields of the gap in units of the field's scale, or relative to the larger value where the scale is 0."""
    of = lambda d: [d[f] for f in FIELDS]
    each = F.arrays_zip(F.array(*of(a)).alias("x"), F.array(*of(b)).alias("y"), F.array(*[F.coalesce(s, F.lit(0.0)) for s in of(scales)]).alias("s"))

    def add(total: Column, f: Column) -> Column:
        x, y, s = f["x"], f["y"], f["s"]
        gap, size = F.abs(x - y), F.greatest(F.abs(x), F.abs(y))
        return total + F.when(s > 0, gap / s).when(size > 0, gap / size).otherwise(0.0)

    return F.aggregate(each, F.lit(0.0), add)


def thread_mass_cap(turns: DataFrame, *keys: str) -> DataFrame:
    """The most turns a thread may give to a sample: the mean size of a thread, rounded up; 0 without threads."""
    n, k = F.count("thread_id"), F.countDistinct("thread_id")
    cap = F.when(k > 0, F.greatest(F.lit(1), F.ceil(n / k))).otherwise(0).cast("bigint").alias("cap")
    return turns.groupBy(*keys).agg(cap) if keys else turns.agg(cap)


def drawable(turns: DataFrame, seed: int, key: str, threads: DataFrame | None = None) -> DataFrame:
    """Turns with their place ``_p`` in a seeded order of their thread, its size ``_n``, the start and step of its draws, ``cap`` and what else ``threads`` has of every thread.

    The place is a rank among the turns of like hash plus the count of smaller
    hashes, so a thread of any length is sorted in parts.
    """
    t = turns.where("thread_id is not null")
    t = t.withColumn("_h", F.sha2(F.concat_ws(":", F.lit(seed), F.lit("order"), "thread_id", F.col(key)), 256)).withColumn("_slot", F.substring("_h", 1, 2))
    w = Window.partitionBy("thread_id")
    slots = t.groupBy("thread_id", "_slot").agg(F.count("*").alias("_c"))
    slots = slots.withColumn("_before", F.sum("_c").over(w.orderBy("_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_c")).withColumn("_n", F.sum("_c").over(w)).drop("_c")
    if threads is not None:
        slots = slots.join(threads, "thread_id")
    t = t.withColumn("_r", F.row_number().over(Window.partitionBy("thread_id", "_slot").orderBy("_h"))).join(slots, ["thread_id", "_slot"])
    d = F.sha2(F.concat_ws(":", F.lit(seed), F.lit("draw"), "thread_id"), 256)
    number = lambda at: F.conv(F.substring(d, at, 8), 16, 10).cast("bigint")
    t = t.withColumns({"_p": F.col("_before") + F.col("_r") - 1, "_start": number(1), "_step": number(9)}).drop("_h", "_slot", "_r", "_before")
    return t.join(F.broadcast(thread_mass_cap(turns)))  # one row


def _taken(j: Column) -> Column:
    """Whether trial ``j`` takes a turn of ``drawable``."""
    return F.pmod(F.col("_p") - F.col("_start") - j * F.col("_step"), F.col("_n")) < F.col("cap")


def drawn(t: DataFrame, trials: int) -> DataFrame:
    """A row per turn of ``drawable`` and trial that takes it.

    A trial takes ``cap`` turns in a row of a thread's order, which is a circle; where
    they begin moves by the thread's step.  So only rows that are taken are ever made.
    """
    every = F.sequence(F.lit(0), F.lit(trials - 1)).cast("array<bigint>")
    return t.withColumn("trial", F.explode(F.filter(every, _taken))).drop("_p", "_n", "_start", "_step", "cap")


def mass_balanced_sample(turns: DataFrame, seed: int = 0, key: str = "source_id", trials: int = 1) -> DataFrame:
    """For every trial up to ``cap`` turns of each thread, drawn by seeded hashes; turns without thread are in none."""
    return drawn(drawable(turns, seed, key), trials)


def _halves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    trial, left, right = None, 0, 0
    for pdf in batches:
        sides = []
        for t, n in zip(pdf["trial"].tolist(), pdf["size"].tolist()):
            if t != trial:
                trial, left, right = t, 0, 0
            sides.append("left" if left <= right else "right")
            if left <= right:
                left += n
            else:
                right += n
        yield pd.DataFrame({"trial": pdf["trial"], "thread_id": pdf["thread_id"], "side": sides})


def balanced_halves(sizes: DataFrame, seed: int = 0) -> DataFrame:
    """Whole threads of every trial, in a seeded order, each to the lighter side.  ``(trial, thread_id, size)`` to ``(trial, thread_id, side)``.

    The rule is sequential: a trial's threads stream through one task in batches, and
    only their sizes reach it.
    """
    order = F.unhex(F.sha2(F.concat_ws(":", F.lit(seed), F.lit("half"), "trial", "thread_id"), 256))
    s = sizes.select("trial", "thread_id", "size").repartition("trial").withColumn("order", order)
    return s.sortWithinPartitions("trial", "order").drop("order").mapInPandas(_halves, "trial bigint, thread_id string, side string")


def _bit(bits: Column, at: Column) -> Column:
    return F.call_function("shiftright", bits, at.cast("int")).bitwiseAND(F.lit(1).cast("bigint"))


def _set_bit(bits: Column, at: Column) -> Column:
    return bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), at.cast("int")))


def _bits_set(t: DataFrame, columns: list[str], n: int, *keep: Column | str) -> DataFrame:
    """A row ``cell`` for each of the first ``n`` bits that is set in the ``columns`` of 64 bits, lowest first."""
    at = F.col("cell")
    t = t.select(*keep, F.array(*columns).alias("_bits"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("cell"))
    return t.where(_bit(F.col("_bits")[F.shiftright(at, 6)], at.bitwiseAND(F.lit(63))) == 1).drop("_bits")


def _sides(turns: DataFrame, trials: int, seed: int) -> tuple[Stage, list[str]]:
    """Of every thread the trials in which it goes to the right, as bits, 32 to a column.

    A trial takes ``cap`` turns of a thread, or all it has, so its share is known
    without the draw.
    """
    n = turns.where("thread_id is not null").groupBy("thread_id").agg(F.count("*").alias("n")).join(F.broadcast(thread_mass_cap(turns)))  # one row
    every = F.explode(F.sequence(F.lit(0), F.lit(trials - 1)).cast("array<bigint>")).alias("trial")
    halves = balanced_halves(n.select("thread_id", F.least("n", "cap").alias("size"), every), seed)
    columns = [f"_r{k}" for k in range(-(-trials // 32))]
    right = lambda k: (F.col("side") == "right") & (F.shiftright("trial", 5) == k)
    one = _set_bit(F.lit(0).cast("bigint"), F.col("trial").bitwiseAND(F.lit(31)))
    bits = [F.bit_or(F.when(right(k), one).otherwise(F.lit(0).cast("bigint"))).alias(c) for k, c in enumerate(columns)]
    return Stage(halves.groupBy("thread_id").agg(*bits), "sides"), columns


def _splits(sides: DataFrame, columns: list[str], trials: int) -> DataFrame:
    """What the halves of a trial are, whichever is the left: ``(trial, split)``.

    A set of threads is the exclusive or of 120 bits of their hashes; the lesser of the
    two halves stands for both, as every trial divides the same threads.
    """
    h = F.sha2("thread_id", 256)
    part = lambda at: F.conv(F.substring(h, at, 15), 16, 10).cast("bigint")
    t = sides.select(*columns, part(1).alias("h1"), part(16).alias("h2"))
    both = F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2")
    every = t.agg(F.bit_xor("h1").alias("t1"), F.bit_xor("h2").alias("t2"))
    wide = [F.col(c).bitwiseOR(F.call_function("shiftleft", F.col(d), F.lit(32))).alias(f"_t{k}") for k, (c, d) in enumerate(zip(columns[::2], columns[1::2]))]
    wide += [F.col(columns[-1]).alias(f"_t{len(wide)}")] * (len(columns) % 2)
    right = _bits_set(t.select("h1", "h2", *wide), [f"_t{k}" for k in range(len(wide))], trials, "h1", "h2").groupBy("cell").agg(*both)
    here, there = F.struct("x1", "x2"), F.struct(F.col("x1").bitwiseXOR(F.col("t1")).alias("x1"), F.col("x2").bitwiseXOR(F.col("t2")).alias("x2"))
    return right.join(F.broadcast(every)).select(F.col("cell").alias("trial"), F.least(here, there).alias("split"))  # one row


def _drawn_fingerprints(turns: DataFrame, trials: int, seed: int, key: str, sides: DataFrame | None = None) -> DataFrame:
    """Fingerprints of every trial's sample, or of its halves by ``sides``: ``(cell, n, ...)`` with cell the trial, or twice the trial and one more on the right.

    The cells of a turn are bits.  Texts are measured once, and a word is gathered
    once with the cells of all turns that have it, not once per turn and trial.
    """
    width = 1 if sides is None else 2
    per, n = 64 // width, width * trials
    firsts = list(enumerate(range(0, trials, per)))

    def cells(k: int, first: int) -> Column:
        some = F.sequence(F.lit(first), F.lit(min(first + per, trials) - 1)).cast("array<bigint>")
        at = lambda j: j - first if sides is None else (j - first) * 2 + _bit(F.col(f"_r{k}"), j - first)
        return F.aggregate(F.filter(some, _taken), F.lit(0).cast("bigint"), lambda bits, j: _set_bit(bits, at(j)))

    columns = [f"_b{k}" for k, _ in firsts]
    t = measured(drawable(turns.select("thread_id", key, "text"), seed, key, sides)).withColumn("_f", F.filter("_words", lambda w: w.isin(*FUNCTION_WORDS)))
    counts = [(F.size("_f") - F.size(F.array_remove("_f", w))).alias(f"_f{i}") for i, w in enumerate(FUNCTION_WORDS)]
    staged = Stage(t.select("_len", "_punct", "_e", "_u", F.size("_words").alias("_w"), F.array_distinct("_words").alias("_types"), *counts, *[cells(k, first).alias(f"_b{k}") for k, first in firsts]), "drawn")
    t = staged.df

    size, total = F.greatest(F.sum("_len"), F.lit(1)), F.greatest(F.sum("_w"), F.lit(1))
    a = _bits_set(t, columns, n, "_len", "_punct", "_e", "_u", "_w", *[f"_f{i}" for i in range(len(FUNCTION_WORDS))]).groupBy("cell").agg(
        F.count("*").alias("n"), F.avg("_len").alias("mean_len"), F.coalesce(F.stddev_pop("_len"), F.lit(0.0)).alias("len_stdev"),
        (F.sum("_punct") / size).alias("punct_rate"), (F.sum("_e") / size).alias("emoji_rate"), (F.sum("_u") / size).alias("upper_rate"), total.alias("_total"),
        *[(F.sum(f"_f{i}") / total).alias(f"fw:{w}") for i, w in enumerate(FUNCTION_WORDS)],
    )
    a = a.withColumn("burstiness", F.when(F.col("mean_len") > 0, F.col("len_stdev") / F.col("mean_len")).otherwise(0.0))
    m = _bits_set(t, columns, n, "_len").groupBy("cell", "_len").agg(F.count("*").alias("_c")).groupBy("cell").agg(F.expr("percentile(_len, 0.5D, _c)").alias("median_len"))
    w = t.select(F.explode("_types").alias("_type"), *columns).groupBy("_type").agg(*[F.bit_or(c).alias(c) for c in columns])
    w = _bits_set(w, columns, n).groupBy("cell").agg(F.count("*").alias("_types"))
    fp = a.join(m, "cell").join(w, "cell", "left").withColumn("type_token_ratio", F.coalesce(F.col("_types") / F.col("_total"), F.lit(0.0)))
    out = Stage(fp.select("cell", "n", *[F.col(f"`{f}`") for f in FIELDS]), "fingerprints").df
    staged.drop()
    return out


def trial_fingerprints(turns: DataFrame, trials: int, seed: int, key: str) -> DataFrame:
    """Fingerprints of both halves of every trial, with what its split is; written once, a row per half."""
    sides, columns = _sides(turns, trials, seed)
    fp = _drawn_fingerprints(turns, trials, seed, key, sides.df)
    split = Stage(_splits(sides.df, columns, trials), "splits").df
    sides.drop()
    fp = fp.withColumns({"trial": F.shiftright("cell", 1), "side": F.when(F.col("cell").bitwiseAND(F.lit(1)) == 1, "right").otherwise("left")}).drop("cell")
    return fp.join(split, "trial")


def self_distance_band(turns: DataFrame, trials: int = 200, seed: int = 0, key: str = "source_id") -> DataFrame:
    """How far halves of one writer's turns lie apart: one row with median, p95, trials, partitions, scales and reason.

    Trials are a column: every trial's sample is halved by whole threads, the
    fields' mean gaps are their scales, and the distances in these units give the
    order statistics n // 2 and floor(0.95 n).  Refused (null median and a reason)
    below eight turns, without a trial of two sides with four turns, and if all
    trials made the same halves.
    """
    fp = trial_fingerprints(turns.where("thread_id is not null"), trials, seed, key).where(F.col("n") >= MIN_SIDE)
    flat = [F.col(f"`{f}`").alias(f) for f in FIELDS]
    a = fp.where("side = 'left'").select("trial", "split", F.struct(*flat).alias("a"))
    b = fp.where("side = 'right'").select("trial", F.struct(*flat).alias("b"))
    p = a.join(b, "trial")
    scales = p.agg(*[F.avg(F.abs(F.col("a")[f] - F.col("b")[f])).alias(f) for f in FIELDS]).select(F.struct(*flat).alias("s"))
    p = p.join(F.broadcast(scales))  # one row
    side = lambda c: {f: F.col(c)[f] for f in FIELDS}
    d = p.select("split", "s", distance(side("a"), side("b"), side("s")).alias("d"))
    g = d.agg(F.count("*").alias("trials"), F.countDistinct("split").alias("partitions"), F.sort_array(F.collect_list("d")).alias("ds"), F.first("s").alias("s"))
    n_turns = turns.agg(F.count("*").alias("n_turns"))
    g = g.join(F.broadcast(n_turns))
    reason = (
        F.when(F.col("n_turns") < 2 * MIN_SIDE, "too few turns")
        .when(F.col("trials") == 0, "no trial gave two halves of enough turns")
        .when(F.col("partitions") < 2, "the threads admit one split only")
        .otherwise("")
    )
    ok = F.col("reason") == ""
    at = lambda i: F.when(ok, F.try_element_at("ds", i.cast("int") + 1))
    g = g.withColumn("reason", reason)
    return g.select(at(F.floor(F.col("trials") / 2)).alias("median"), at(F.floor(F.col("trials") * F.lit(0.95).cast("double"))).alias("p95"), "trials", "partitions", F.when(ok, F.col("s")).alias("scales"), "reason")


def corpus_distance(a: DataFrame, b: DataFrame, band: DataFrame, draws: int = 25, seed: int = 0, key: str = "source_id") -> DataFrame:
    """Mean distance of mass-balanced samples of two bodies of turns in a band's units; null if the band was refused or a side is empty."""
    flat = [F.col(f"`{f}`").alias(f) for f in FIELDS]
    side = lambda c: {f: F.col(c)[f] for f in FIELDS}
    fa = _drawn_fingerprints(a, draws, seed, key).select("cell", F.struct(*flat).alias("a"))
    fb = _drawn_fingerprints(b, draws, seed + 1, key).select("cell", F.struct(*flat).alias("b"))
    j = fa.join(fb, "cell").join(F.broadcast(band.where("reason = ''").select(F.col("scales").alias("s"))))
    return j.agg(F.avg(distance(side("a"), side("b"), side("s"))).alias("distance"), F.count("*").alias("draws"))
