"""Walks along parent links: ledger histories and live branches of conversation graphs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.session import Stage

LEVELS = 6


def ancestors(entries: DataFrame, starts: DataFrame, id_: str = "entry_id", parents: str = "parents", strict: bool = True) -> DataFrame:
    """``(start, entry, depth)`` of every entry reachable over parent links, at its least depth; a start is its own at depth 0.

    ``starts`` has the column ``start``.  Breadth first, ``LEVELS`` steps a
    job; entries met again keep their least depth, so cycles end.  With
    ``strict`` a start or parent that is no entry is an error, else it is left out.
    """
    known = entries.select(F.col(id_).alias("entry")).distinct()
    links = entries.select(F.col(id_).alias("entry"), F.explode(parents).alias("parent")).distinct()
    s = starts.select("start").distinct()
    if strict:
        if bad := s.join(known, F.col("start") == F.col("entry"), "left_anti").head(1):
            raise KeyError(f"no entry {bad[0][0]}")
    frontier = s.join(known, F.col("start") == F.col("entry")).select("start", "entry", F.lit(0).alias("depth"))
    if strict and (bad := links.join(known, F.col("parent") == known["entry"], "left_anti").head(1)):
        raise KeyError(f"dangling parent {bad[0]['parent']}")
    links = links.join(known.select(F.col("entry").alias("parent")), "parent", "left_semi")
    seen = Stage(frontier, "walk")
    depth = 0
    while True:
        # several levels in one job; entries met again keep their least depth
        step = seen.df.where(F.col("depth") == depth)
        found = []
        for d in range(depth + 1, depth + LEVELS + 1):
            step = step.select("start", "entry").join(links, "entry").select("start", F.col("parent").alias("entry")).distinct().withColumn("depth", F.lit(d))
            found.append(step)
        every = seen.df
        for f in found:
            every = every.unionByName(f)
        new = Stage(every.groupBy("start", "entry").agg(F.min("depth").alias("depth")), "walk")
        seen.drop()
        seen = new
        depth += LEVELS
        if not seen.df.where(F.col("depth") == depth).head(1):
            return seen.df


@F.pandas_udf(T.ArrayType(T.StringType()))
def _walk(current: pd.Series, nodes: pd.Series, parents: pd.Series) -> pd.Series:
    out = []
    for at, ids, ups in zip(current, nodes, parents):
        up = dict(zip(ids, ups)) if ids is not None else {}
        path: dict[str, None] = {}
        while at is not None and at in up and at not in path:
            path[at] = None
            at = up[at]
        out.append(list(reversed(path)))
    return pd.Series(out, dtype=object)


def live_branch(conversations: DataFrame) -> DataFrame:
    """The nodes from each conversation's root to its current leaf, in order.

    ``conversations`` has conversation_id, current_node and mapping (map of node to
    a struct with ``parent``), a graph in one row as exports have it.  Only ids reach
    Python; a walk looks every node up once and stops at one seen before.
    ``(conversation_id, branch)``.
    """
    parents = F.transform(F.map_values("mapping"), lambda n: n["parent"])
    return conversations.select("conversation_id", _walk(F.col("current_node"), F.map_keys("mapping"), parents).alias("branch"))


def live_branch_rows(nodes: DataFrame, current: DataFrame) -> DataFrame:
    """The same for graphs with a row per node: ``(conversation_id, pos, id)`` from the root (1) to the current node.

    ``nodes`` has conversation_id, id, parent (ids are unique in a conversation),
    ``current`` conversation_id and id.  Steps of 1, 2, 4, ... parents are joined as
    long as any node has one so far up, so a chain of n takes log2(n) joins and no
    conversation is ever one row.  A parent that is no node ends the walk; a cycle
    ends it at the node seen before.
    """
    n = nodes.select("conversation_id", "id", "parent").where("id is not null")
    step = n.join(n.select("conversation_id", F.col("id").alias("parent")), ["conversation_id", "parent"]).select("conversation_id", "id", F.col("parent").alias("up"))
    walk = Stage(current.select("conversation_id", "id").join(n.select("conversation_id", "id"), ["conversation_id", "id"]).withColumn("above", F.lit(0)), "branch")
    jump, width = Stage(step, "jump"), 1
    while True:
        # all nodes within width - 1 steps are there; the next as many are one jump from them
        far = walk.df.join(jump.df, ["conversation_id", "id"]).select("conversation_id", F.col("up").alias("id"), (F.col("above") + width).alias("above"))
        new = Stage(walk.df.unionByName(far).groupBy("conversation_id", "id").agg(F.min("above").alias("above")), "branch")
        grown = new.df.count() > walk.df.count()
        walk.drop()
        walk = new
        if not grown:
            break
        twice = jump.df.join(jump.df.select("conversation_id", F.col("id").alias("up"), F.col("up").alias("up2")), ["conversation_id", "up"])
        nxt = Stage(twice.select("conversation_id", "id", F.col("up2").alias("up")), "jump")
        jump.drop()
        jump, width = nxt, width * 2
    jump.drop()
    last = walk.df.groupBy("conversation_id").agg(F.max("above").alias("last"))
    return walk.df.join(last, "conversation_id").select("conversation_id", (F.col("last") - F.col("above") + 1).alias("pos"), "id")
