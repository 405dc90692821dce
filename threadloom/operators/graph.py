"""Connected components by alternating large-star and small-star steps.

Every step is a partial-aggregated minimum per node and one join against a side
with one row per node, so a hub with a third of all edges is folded map-side
and split by the adaptive skew join, never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.session import Stage

#: Nodes that one task keeps in memory before it hands on what it has.
FOREST = 1_000_000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Reduce the edges of one partition to spanning forests of stars, ``FOREST`` nodes at a time."""
    parent: dict = {}

    def stars():
        out = [(x, r) for x in parent if (r := root(x)) != x]
        return pd.DataFrame(out, columns=["src", "dst"]) if out else None

    def root(x):
        r = x
        while parent.get(r, r) != r:
            r = parent[r]
        while parent.get(x, x) != r:
            parent[x], x = r, parent[x]
        return r

    for pdf in batches:
        for a, b in zip(pdf["src"].tolist(), pdf["dst"].tolist()):
            ra, rb = root(a), root(b)
            if ra != rb:
                lo, hi = (ra, rb) if ra < rb else (rb, ra)
                parent[hi] = lo
                parent.setdefault(lo, lo)
        if len(parent) > FOREST:
            if (out := stars()) is not None:
                yield out
            parent.clear()
    if (out := stars()) is not None:
        yield out


def _stars(e: DataFrame) -> bool:
    """Whether every node either points to one centre or is one."""
    ends = e.select(F.col("src").alias("x"), F.lit(1).alias("s"), F.lit(0).alias("d")).unionByName(e.select(F.col("dst").alias("x"), F.lit(0).alias("s"), F.lit(1).alias("d")))
    n = ends.groupBy("x").agg(F.sum("s").alias("s"), F.max("d").alias("d"))
    return not n.where("s > 1 or (s = 1 and d = 1)").head(1)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Component of every node that has an edge: rows ``(node, component)``.

    ``component`` is the smallest node of the component in the column's order
    (code points for strings).  Null ends and loops are ignored, repeated edges
    count once; no edges give no rows.  ``RuntimeError`` if not settled after
    ``max_rounds`` (each round shrinks path lengths geometrically).
    """
    schema = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).schema
    e = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where("src is not null and dst is not null and src <> dst")
    stage = Stage(e.mapInPandas(_forest, schema), "cc")
    for _ in range(max_rounds):
        if _stars(stage.df):
            break
        # large star: every larger neighbour is linked to the smallest node around u
        both = stage.df.unionByName(stage.df.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
        large = both.join(low, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src <> dst")
        # small star: u and its smaller neighbours are linked to the smallest of them
        down = large.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
        low = down.groupBy("src").agg(F.min("dst").alias("m"))
        small = down.join(low, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src <> dst")
        nxt = Stage(small.unionByName(low.select("src", F.col("m").alias("dst"))).distinct(), "cc")
        stage.drop()
        stage = nxt
    else:
        raise RuntimeError("connected components did not settle")
    e = stage.df
    return e.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(
        e.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    )
