"""Problem 5: groups of turns that repeat each other's text with small changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.near import Banded
from threadloom.operators.graph import connected_components


def near_duplicate_groups(turns: DataFrame) -> DataFrame:
    """Rows ``(group_id, turn_id)`` of every turn that is near another, or chained to one by near turns.

    Two turns are near if both have at least 24 distinct words and the Jaccard
    similarity of these is at least 0.7.  Candidates come from a binary trie
    self-join of one-bit minhash signatures within blocks of shared minhash bands;
    each is checked on its words.  Classes of a hot block are first linked to one of
    it, and node pairs whose leaves are linked already are not descended.  Rows
    without turn_id and null, empty and short texts are in no group; repeated rows
    count once; an empty table gives no rows; copies are one class and never paired.
    ``group_id`` is the smallest ``turn_id`` of the group.  Other columns are ignored.
    """
    t = turns.select(F.col("turn_id").cast("bigint").alias("turn_id"), F.col("text").cast("string").alias("text"), F.lit(None).cast("int").alias("side"))
    b = Banded(t, cross=False)
    near = b.near()
    b.drop()
    comp = connected_components(near, "a", "b").withColumnRenamed("node", "cls")
    classes = b.member.groupBy("cls").agg(F.min("turn_id").alias("low"), F.count("*").alias("n"))
    classes = classes.join(comp, "cls", "left").withColumn("g", F.coalesce("component", "cls"))
    groups = classes.groupBy("g").agg(F.min("low").alias("group_id"), F.sum("n").alias("n")).where("n > 1")
    named = classes.join(groups.select("g", "group_id"), "g").select("cls", "group_id")
    return b.member.join(named, "cls").select("group_id", "turn_id")
