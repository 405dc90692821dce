"""Problem 1: splits that keep related threads together."""

from __future__ import annotations

import math
from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.operators.graph import connected_components
from threadloom.session import Stage, collect_bounded

#: Equal turns (time and text) that make two threads one session.
SHARED_TURNS = 3
#: A turn that more threads hold links them to one of them first.
HOT = 1000
#: Bundles the driver solves for; more is an error.  So many distinct sizes, even over 255 sets of sources, take more than 7 billion turns.
MAX_BUNDLES = 2_000_000


def _source() -> Column:
    return F.lower(F.regexp_replace("source", r"(?U)^\s+|\s+$", ""))


def _path(p: Column) -> Column:
    """A path with separators, empty steps, ``.`` and ``..`` resolved; case is kept."""
    p = F.regexp_replace(F.regexp_replace(F.trim(p), r"\\", "/"), r"(?i)^file:(//(localhost)?)?(?=/)", "")
    steps = F.aggregate(
        F.split(p, "/"),
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x.isin("", "."), acc).when((x == "..") & (F.size(acc) > 0), F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == "..", acc).otherwise(F.concat(acc, F.array(x))),
    )
    return F.concat(F.when(p.startswith("/"), "/").otherwise(""), F.array_join(steps, "/"))


def _address(a: Column) -> Column:
    """An electronic address without display name, brackets, scheme, blanks and case."""
    inner = F.regexp_extract(a, r"<([^<>]*)>\s*$", 1)
    a = F.when(inner != "", inner).otherwise(a)
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(a, r"(?U)\s", ""), r"(?i)^mailto:", ""), r"[?].*$", ""))


def identity_key(source: Column, thread: Column) -> Column:
    """What a thread id denotes: a mailbox, a line or address of a one-to-one chat, a file or a repository; null if only itself."""
    chat = F.regexp_extract(thread, r"(?i)^\s*[a-z]+;-;(.*)$", 1)
    num = F.regexp_replace(F.regexp_replace(chat, r"(?i)^\s*tel:", ""), r"[^0-9+]", "")
    phone = F.concat(F.lit("tel:"), F.regexp_replace(num, r"^00", "+"))
    mail = _address(thread)
    repo = F.regexp_replace(_path(thread), r"(?<=[^/])/?\.git$", "")
    return (
        F.when((source == "mail") & mail.contains("@"), F.concat(F.lit("addr:"), mail))
        .when((source == "imessage") & chat.contains("@"), F.concat(F.lit("addr:"), _address(chat)))
        .when((source == "imessage") & (chat != "") & (F.length(num) > 3), phone)
        .when((source == "claude_code") & thread.rlike(r"[/\\]"), F.concat(F.lit("file:"), _path(thread)))
        .when((source == "git_repos") & thread.rlike(r"[/\\]"), F.concat(F.lit("repo:"), repo))
    )


def _with_three(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """Of pairs (src, dst) of threads those that hold ``SHARED_TURNS`` turns together."""
    n = pairs.join(held.withColumnRenamed("thread_id", "src"), "src").join(held.withColumnRenamed("thread_id", "dst"), ["dst", "h"])
    return n.groupBy("src", "dst").agg(F.count("*").alias("n")).where(F.col("n") >= SHARED_TURNS).select("src", "dst")


def _meetings(g: DataFrame) -> DataFrame:
    """Pairs of threads that hold a turn together and are not linked yet: (thread_id, h, comp) to (src, dst)."""
    other = g.select(F.col("thread_id").alias("dst"), F.col("comp").alias("comp2"), "h")
    return g.withColumnRenamed("thread_id", "src").join(other, "h").where("src < dst and comp <> comp2").select("src", "dst").distinct()


def _shared_sessions(turns: DataFrame) -> DataFrame:
    """Edges between threads with at least ``SHARED_TURNS`` equal non-blank turns.

    Threads with the same set of shared turns are linked to the least of them and
    only that one goes on.  Of the rest, each thread leaves out the two turns that
    most threads hold: a pair with three turns in common still meets in its rarest.
    Threads under a turn that more than ``HOT`` of them hold are linked to the
    least of those first, linear in their number.  If the rarest turn of a pair is hot
    all its turns are, so threads with fewer than three hot turns meet in the others
    only, and hot turns whose threads are linked among themselves are left out.
    """
    t = turns.where(r"thread_id is not null and ts is not null and text rlike '(?U)\\S'")
    t = t.select("thread_id", F.xxhash64("ts", "text").alias("h")).distinct()
    both = t.groupBy("h").agg(F.min("thread_id").alias("lo"), F.max("thread_id").alias("hi"), F.count("*").alias("f")).where("lo <> hi").select("h", "f")
    s = Stage(t.join(both, "h"), "shared")
    per = s.df.groupBy("thread_id").agg(F.count("*").alias("n"), F.sum(F.xxhash64("h").cast("decimal(38,0)")).alias("mark"), F.max(F.struct("f", "h")).alias("m1")).where(F.col("n") >= SHARED_TURNS)
    rep = per.groupBy("n", "mark").agg(F.min("thread_id").alias("rep"))
    per = Stage(per.join(rep, ["n", "mark"]), "threads")
    same = per.df.where("thread_id <> rep").select(F.col("thread_id").alias("src"), F.col("rep").alias("dst"))
    own = s.df.join(per.df.where("thread_id = rep").select("thread_id", F.col("m1.h").alias("h1")), "thread_id")
    second = own.where("h <> h1").groupBy("thread_id").agg(F.max(F.struct("f", "h")).alias("m2")).select("thread_id", F.col("m2.h").alias("h2"))
    gen = own.where("h <> h1").join(second, "thread_id").where("h <> h2").select("thread_id", "h", "f")
    held = own.select("thread_id", "h")
    if not s.df.where(F.col("f") > HOT).head(1):
        return same.unionByName(_with_three(_meetings(gen.select("thread_id", "h", F.col("thread_id").alias("comp"))), held))
    hot = own.where(F.col("f") > HOT).select("thread_id", "h")
    many = hot.groupBy("thread_id").agg(F.count("*").alias("n")).where(F.col("n") >= SHARED_TURNS).select("thread_id")
    hot = Stage(hot.join(many, "thread_id"), "hot").df
    centre = hot.groupBy("h").agg(F.min("thread_id").alias("dst"))
    stars = Stage(_with_three(hot.withColumnRenamed("thread_id", "src").join(centre, "h").where("src <> dst").select("src", "dst").distinct(), held), "stars").df
    comp = connected_components(stars).select(F.col("node").alias("thread_id"), "component")
    hot = hot.join(comp, "thread_id", "left").withColumn("comp", F.coalesce("component", "thread_id")).drop("component")
    open_ = hot.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("h")
    few = gen.where(F.col("f") <= HOT).select("thread_id", "h", F.col("thread_id").alias("comp"))
    left = hot.join(open_, "h").select("thread_id", "h", "comp")
    met = _meetings(few).unionByName(_meetings(left)).distinct()
    return same.unionByName(stars).unionByName(_with_three(met, held))


def thread_components(turns: DataFrame) -> DataFrame:
    """``(node, component)`` of every thread id that belongs together with another one.

    Threads are linked that denote the same mailbox, line, address, file or
    repository, or that have three non-blank turns equal in ``ts`` and ``text``;
    chains count.  Null thread ids, times and texts link nothing; no rows if no
    threads are linked.
    """
    t = turns.select("thread_id", _source().alias("source"), "ts", "text")
    ids = t.select("source", "thread_id").where("thread_id is not null").distinct()
    ids = ids.withColumn("k", identity_key(F.col("source"), F.col("thread_id"))).where("k is not null").select("thread_id", "k").distinct()
    ids = Stage(ids, "ids").df
    low = ids.groupBy("k").agg(F.min("thread_id").alias("dst"))
    named = ids.join(low, "k").where("thread_id <> dst").select(F.col("thread_id").alias("src"), "dst")
    return connected_components(named.unionByName(_shared_sessions(t)))


def related_threads(turns: DataFrame) -> DataFrame:
    """Every pair ``(thread_a, thread_b)``, thread_a < thread_b by code points, of one component."""
    c = thread_components(turns)
    c = Stage(c, "components").df
    a, b = c.select("component", F.col("node").alias("thread_a")), c.select("component", F.col("node").alias("thread_b"))
    return a.join(b, "component").where("thread_a < thread_b").select("thread_a", "thread_b")


class Flow:
    """Minimum-cost flow by successive shortest paths; capacities and flows are whole numbers."""

    def __init__(self, n: int):
        self.to: list[list[int]] = [[] for _ in range(n)]
        self.arcs: list[list] = []  # head, residual capacity, cost

    def add(self, u: int, v: int, cap: int, cost: float) -> int:
        for a, b, c, w in ((u, v, cap, cost), (v, u, 0, -cost)):
            self.to[a].append(len(self.arcs))
            self.arcs.append([b, c, w])
        return len(self.arcs) - 2

    def run(self, s: int, t: int) -> float:
        total = 0.0
        while True:
            dist, via, queue, inside = {s: 0.0}, {}, deque([s]), {s}
            while queue:
                u = queue.popleft()
                inside.discard(u)
                for e in self.to[u]:
                    v, c, w = self.arcs[e]
                    if c > 0 and dist[u] + w < dist.get(v, math.inf) - 1e-12:
                        dist[v], via[v] = dist[u] + w, e
                        if v not in inside:
                            inside.add(v)
                            queue.append(v)
            if t not in dist:
                return total
            path, v = [], t
            while v != s:
                path.append(via[v])
                v = self.arcs[via[v] ^ 1][0]
            push = min(self.arcs[e][1] for e in path)
            for e in path:
                self.arcs[e][1] -= push
                self.arcs[e ^ 1][1] += push
            total += push * dist[t]


def solve_quotas(bundles: list[tuple[str, int, int]], shares: dict[str, float]) -> dict[tuple[str, int], dict[str, int]]:
    """Components per split of every bundle ``(profile, size, count)``.

    Rows flow from bundles to quotas of (profile, split) and on to quotas of the
    splits.  Rows beyond a profile's quota cost 1, beyond a split's quota 10; a
    component that is larger than a quota costs its overshoot there.  Bundles of a
    profile with the same costs are one node, which leaves the optimum as it is.
    Flows are rounded to whole components from the largest to the smallest, each
    where most of the flow is still open.
    """
    splits = [s for s, x in sorted(shares.items()) if x > 0]
    whole = sum(shares[s] for s in splits)
    if not bundles or not splits:
        return {}
    by: dict[str, int] = {}
    for p, size, n in bundles:
        by[p] = by.get(p, 0) + size * n
    total = sum(by.values())
    quota = {(p, s): round(by[p] * shares[s] / whole) for p in by for s in splits}

    def costs(p: str, size: int) -> tuple[float, ...]:
        return tuple(round(20 * max(0, size - quota[p, s]) / size, 3) if size > 1 else 0.0 for s in splits)

    nodes: dict[tuple, int] = {}
    for p, size, n in bundles:
        k = (p, costs(p, size))
        nodes[k] = nodes.get(k, 0) + size * n
    names: dict[object, int] = {}
    ident = lambda x: names.setdefault(x, len(names))
    for x in ("source", "sink", *splits, *nodes, *quota):
        ident(x)
    g = Flow(len(names))
    out = {}
    for k, rows in nodes.items():
        g.add(ident("source"), ident(k), rows, 0)
        for s, c in zip(splits, k[1]):
            out[k, s] = g.add(ident(k), ident((k[0], s)), total, c)
    for (p, s), q in quota.items():
        g.add(ident((p, s)), ident(s), q, 0)
        g.add(ident((p, s)), ident(s), total, 1)
    for s in splits:
        g.add(ident(s), ident("sink"), round(total * shares[s] / whole), 0)
        g.add(ident(s), ident("sink"), total, 10)
    g.run(ident("source"), ident("sink"))
    left = {k: {s: g.arcs[out[k, s] ^ 1][1] for s in splits} for k in nodes}
    drift = dict.fromkeys(splits, 0)
    result = {}
    for p, size, n in sorted(bundles, key=lambda b: (-b[1], b[0])):
        r = left[p, costs(p, size)]
        open_ = sum(max(0, x) for x in r.values()) or 1
        take = {s: min(n, math.floor(n * max(0, r[s]) / open_)) for s in splits}
        for _ in range(n - sum(take.values())):
            best = max(splits, key=lambda s: (r[s] - take[s] * size + drift[s], s))
            take[best] += 1
        for s in splits:
            r[s] -= take[s] * size
        # what one profile could not place moves on to the smaller bundles of all
        if size > 1:
            for s in splits:
                drift[s] = sum(x[s] for x in left.values() if x[s] < 0)
        result[p, size] = take
    return result


def assign_splits(turns: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """``(turn_id, component, split_name)``: every turn with the split of its component.

    Components are ``thread_components``; a thread in none is one by itself, and so
    is a turn without thread id.  Components are bundled by size and set of
    sources, ``solve_quotas`` says how many of each bundle go to which split, and
    members are counted off in the order of their hash.  Targets that do not add up to 1
    are scaled; targets of 0 or null get nothing; without targets no turn gets a
    row.  Equal input gives the equal result in any order of the rows.
    """
    spark: SparkSession = turns.sparkSession
    shares = {r["split_name"]: float(r["target_share"] or 0) for r in collect_bounded(targets.where("split_name is not null"), 1000)}
    comp = thread_components(turns)
    t = turns.select("turn_id", "thread_id", _source().alias("source"))
    t = t.join(comp.withColumnRenamed("node", "thread_id"), "thread_id", "left")
    t = Stage(t.select("turn_id", "source", F.coalesce("component", "thread_id", F.concat(F.lit("turn:"), F.col("turn_id").cast("string"))).alias("component")), "turns").df
    sized = t.groupBy("component").agg(F.count("*").alias("size"), F.array_join(F.sort_array(F.collect_set(F.coalesce("source", F.lit("")))), "+").alias("profile"))
    sized = Stage(sized.withColumn("order", F.xxhash64(F.lit(seed), "component")), "sized").df
    # the place of a member in its bundle: a rank among those of like hash plus the count of smaller ones
    sized = sized.withColumn("slot", F.shiftright("order", 52))
    bundle = ["profile", "size"]
    slots = sized.groupBy(*bundle, "slot").agg(F.count("*").alias("c"))
    slots = slots.withColumn("before", F.sum("c").over(Window.partitionBy(*bundle).orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("c")).drop("c")
    member = sized.withColumn("r", F.row_number().over(Window.partitionBy(*bundle, "slot").orderBy("order", "component"))).join(slots, [*bundle, "slot"])
    bundles = [(r["profile"], r["size"], r["n"]) for r in collect_bounded(sized.groupBy(*bundle).agg(F.count("*").alias("n")), MAX_BUNDLES)]
    plan = solve_quotas(bundles, shares)
    rows = []
    for (p, s), take in sorted(plan.items()):
        at = 0
        for name in sorted(take):
            if take[name]:
                rows.append((p, s, at, at + take[name], name))
                at += take[name]
    cut = spark.createDataFrame(rows, "profile string, size bigint, lo bigint, hi bigint, split_name string")
    rank = F.col("before") + F.col("r") - 1
    named = member.join(cut, bundle).where((rank >= F.col("lo")) & (rank < F.col("hi"))).select("component", "split_name")
    return t.select("turn_id", "component").join(named, "component").select("turn_id", "component", "split_name")


def split_report(turns: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """Turns, components and reached share per split beside its target."""
    a = assign_splits(turns, targets, seed)
    n = a.groupBy("split_name").agg(F.count("*").alias("n_turns"), F.countDistinct("component").alias("n_components"))
    total = n.agg(F.sum("n_turns").alias("total"))
    n = targets.where("split_name is not null").select("split_name", "target_share").join(n, "split_name", "left").join(F.broadcast(total), how="left")
    return n.select("split_name", "target_share", F.coalesce("n_turns", F.lit(0)).alias("n_turns"), F.coalesce("n_components", F.lit(0)).alias("n_components"), F.round(F.coalesce("n_turns", F.lit(0)) / F.col("total"), 6).alias("share"))
