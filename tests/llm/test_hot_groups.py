"""Hot turns, large bundles, large clusters and the size of the leak search."""

import random
from datetime import timedelta

from threadloom.llm import leakage, packing, splits

from .conftest import T0


def brute_sessions(rows):
    by = {}
    for r in rows:
        by.setdefault(r["thread_id"], set()).add((r["ts"], r["text"]))
    ids = sorted(by)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if len(by[a] & by[b]) >= 3:
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    groups = {}
    for i in ids:
        groups.setdefault(root(i), []).append(i)
    return {(a, b) for g in groups.values() for a in g for b in g if a < b}


def test_hot_turns_link_as_brute_force_does(make_turns, monkeypatch):
    monkeypatch.setattr(splits, "HOT", 4)
    r = random.Random(5)
    for trial in range(4):
        rows = []
        for k in range(40):
            turns = r.sample(range(6), r.choice([1, 2, 2, 3, 4])) if k % 2 else r.sample(range(6, 60), 4) + r.sample(range(6), r.choice([0, 2]))
            rows += [{"source": "other", "thread_id": f"t{k:02d}", "ts": T0 + timedelta(minutes=i), "text": f"say {i}"} for i in turns]
        got = {tuple(x) for x in splits.related_threads(make_turns(rows)).collect()}
        assert got == brute_sessions(rows), trial


def test_members_are_counted_off_exactly(spark, make_turns):
    rows = [{"source": "other", "thread_id": f"t{i}", "text": "x"} for i in range(1000)] + [{"source": "more", "thread_id": f"u{i // 4}", "text": "x"} for i in range(400)]
    t = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split_name string, target_share double")
    n = {(r["split_name"], r["source"]): r["count"] for r in splits.assign_splits(make_turns(rows), t).join(make_turns(rows).select("turn_id", "source"), "turn_id").groupBy("split_name", "source").count().collect()}
    assert n == {("train", "other"): 800, ("validation", "other"): 100, ("test", "other"): 100, ("train", "more"): 320, ("validation", "more"): 40, ("test", "more"): 40}


def test_large_clusters_are_spread_evenly():
    r = random.Random(6)
    size = [r.randint(5, 30) for _ in range(600)]
    cluster = ["hot" if i % 3 == 0 else f"c{i % 7}" if i % 3 == 1 and i < 60 else None for i in range(600)]
    got = packing.best_fit(size, [0] * 600, cluster, 100)
    must = -(-sum(size) // 100)
    cap = -(-cluster.count("hot") // must)
    assert cap == 2
    held = {}
    for g, c, s in zip(got, cluster, size):
        held.setdefault(g, []).append((c, s))
    assert max(sum(c == "hot" for c, _ in x) for x in held.values()) <= cap and all(sum(s for _, s in x) <= 100 for x in held.values())
    assert all(len({c for c, _ in x if c and c != "hot"}) == sum(bool(c) and c != "hot" for c, _ in x) for x in held.values())
    assert len(held) <= must * 1.1


def test_what_the_automaton_knows_grows_with_the_items():
    r = random.Random(7)
    vocab = [f"w{i}" for i in range(300)]
    held = []
    for n in (50, 500):
        a = leakage.Automaton([(i, r.choices(vocab, k=40)) for i in range(n)])
        held.append(sum(map(len, a.holds.values())))
    assert held[1] <= 11 * held[0]


def test_reports_keep_budgets_of_one_name_apart(spark):
    d = spark.createDataFrame([(i, "some words here", "s") for i in range(20)], "doc_id bigint, text string, source string")
    b = spark.createDataFrame([("x", 8), ("x", 16)], "budget_name string, capacity_tokens bigint")
    got = {r["capacity_tokens"]: (r["n_items"], r["fullest"]) for r in packing.pack_report(d, b).collect()}
    assert set(got) == {8, 16} and all(n == 20 and f <= c for c, (n, f) in got.items())
