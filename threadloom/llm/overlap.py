"""Problem 3: evaluation texts that recur, exactly or almost, in training turns."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.near import Banded
from threadloom.llm.suffixes import SHINGLE, Suffixes
from threadloom.llm.words import Hasher, words
from threadloom.session import Stage


def shared_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, jaccard, text_a, text_b) to (a, b, jaccard, covered): words of the first text within runs of ``SHINGLE`` or more that the second has too."""
    h = Hasher()
    for b in batches:
        covered = []
        for x, y in zip(b.column("text_a").to_pylist(), b.column("text_b").to_pylist()):
            one, two = ([h[w] for w in words(t)] for t in (x, y))
            runs = {tuple(two[i : i + SHINGLE]) for i in range(len(two) - SHINGLE + 1)}
            n = end = 0
            for i in range(len(one) - SHINGLE + 1):
                if tuple(one[i : i + SHINGLE]) in runs:
                    n += i + SHINGLE - max(i, end)
                    end = i + SHINGLE
            covered.append(n)
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), b.column("jaccard"), pa.array(covered, pa.int32())], names=["a", "b", "jaccard", "covered"])


def _side() -> F.Column:
    e = F.lower(F.trim("eval_split"))
    return F.when(e == "train", 0).when(e.isin("validation", "heldout"), 1)


def _sides(turns: DataFrame) -> DataFrame:
    t = turns.withColumn("side", _side()).where("side is not null")
    return t.select(F.col("turn_id").cast("bigint").alias("turn_id"), F.col("text").cast("string").alias("text"), "side")


def _pairs(turns: DataFrame, suffixes: Suffixes, covered: bool) -> DataFrame:
    t = _sides(turns)
    b = Banded(t, cross=True)
    cls = b.member.select("turn_id", "cls").distinct()
    runs = suffixes.pairs.df.join(cls.select(F.col("turn_id").alias("eval_turn"), F.col("cls").alias("x")), "eval_turn").join(cls.select(F.col("turn_id").alias("train_turn"), F.col("cls").alias("y")), "train_turn")
    near = b.near(runs.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    suffixes.pairs.drop()
    if covered:
        rep = b.reps.df.join(t, "turn_id")
        texts = near.join(rep.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a").join(rep.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
        near = texts.select("a", "b", "jaccard", "text_a", "text_b").mapInArrow(shared_words, "a bigint, b bigint, jaccard double, covered int")
    else:
        near = near.withColumn("covered", F.lit(None).cast("int"))
    near = near.select("a", "b", "covered", "jaccard")
    same = b.reps.df.where("tr = 1 and ev = 1").select(F.col("cls").alias("a"), F.col("cls").alias("b"), F.lit(None).cast("int").alias("covered"), F.lit(1.0).alias("jaccard"))
    swapped = near.select(F.col("b").alias("a"), F.col("a").alias("b"), "covered", "jaccard")
    ways = Stage(near.unionByName(swapped).unionByName(same), "ways")
    b.drop()
    member = b.member
    left = member.where("side = 0").select(F.col("turn_id").alias("train_turn"), F.col("cls").alias("a"))
    right = member.where("side = 1").select(F.col("turn_id").alias("eval_turn"), F.col("cls").alias("b"))
    return left.join(ways.df, "a").join(right, "b").withColumn("exact", F.col("a") == F.col("b")).drop("a", "b")


def cross_split_overlaps(turns: DataFrame) -> DataFrame:
    """One row per training turn and evaluation turn that share at least 70% of their distinct words.

    Columns: train_turn, eval_turn, jaccard, covered (words of one of the two texts,
    the same for all copies, that lie in shared runs of eight or more words, 0
    without such a run; null if their word sets are equal), exact (equal word sets).

    Candidates are evaluation texts and the training texts next to their suffixes in
    sorted order, and training and evaluation texts that share a band of minhashes, in
    whatever order their words stand; each pair is checked on its distinct words (24
    or more in both).  Turns of other splits, null or short texts take no part; an
    empty table gives no rows.  Every pair of turns comes out, copies included.
    """
    return _pairs(turns, Suffixes(_sides(turns), cover=False), covered=True)


def overlap_pairs(turns: DataFrame) -> DataFrame:
    """``(turn_a, turn_b)`` with turn_a < turn_b of ``cross_split_overlaps``."""
    p = _pairs(turns, Suffixes(_sides(turns), cover=False), covered=False)
    return p.select(F.least("train_turn", "eval_turn").alias("turn_a"), F.greatest("train_turn", "eval_turn").alias("turn_b"))


def covered_turns(turns: DataFrame) -> DataFrame:
    """``(turn_id, n_words, covered_words)``: words of every evaluation turn, and how many lie in runs of eight or more words that some training turn has too."""
    return Suffixes(_sides(turns), cover=True).covered.df


def overlap_report(turns: DataFrame) -> DataFrame:
    """Pairs, evaluation turns and training turns per evaluation split and pair of sources, exact and near apart.

    ``n_eval_words`` are the words of the evaluation turns, ``n_covered_words`` those of
    them in runs of eight or more that training turns of any source have too.
    """
    s = Suffixes(_sides(turns), cover=True)
    p = _pairs(turns, s, covered=False)
    about = turns.select(F.col("turn_id").cast("bigint").alias("turn_id"), F.lower(F.trim("eval_split")).alias("split"), F.lower(F.trim("source")).alias("source"), "thread_id")
    p = p.join(about.select(F.col("turn_id").alias("train_turn"), F.col("source").alias("train_source"), F.col("thread_id").alias("t")), "train_turn")
    p = p.join(about.select(F.col("turn_id").alias("eval_turn"), F.col("split").alias("eval_split"), F.col("source").alias("eval_source"), F.col("thread_id").alias("e")), "eval_turn")
    by = ["eval_split", "eval_source", "train_source"]
    report = p.groupBy(*by).agg(
        F.count("*").alias("n_pairs"),
        F.sum(F.col("exact").cast("bigint")).alias("n_same_words"),
        F.sum(F.coalesce((F.col("t") == F.col("e")).cast("bigint"), F.lit(0))).alias("n_same_thread"),
        F.countDistinct("eval_turn").alias("n_eval_turns"),
        F.countDistinct("train_turn").alias("n_train_turns"),
        F.round(F.avg("jaccard"), 6).alias("mean_jaccard"),
    )
    words = s.covered.df.groupBy("turn_id").agg(F.max("n_words").alias("n"), F.max("covered_words").alias("c"))
    words = p.select(*by, F.col("eval_turn").alias("turn_id")).distinct().join(words, "turn_id")
    words = words.groupBy(*[F.col(c).alias(f"of_{c}") for c in by]).agg(F.sum("n").alias("n_eval_words"), F.sum("c").alias("n_covered_words"))
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in by]
    return report.join(words, same).select(*report.columns, "n_eval_words", "n_covered_words")
