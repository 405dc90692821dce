import os
import random

import pytest
from pyspark.sql import functions as F

from threadloom.llm import mixing, packing, splits


def related(make_turns, rows):
    return {tuple(r) for r in splits.related_threads(make_turns(rows)).collect()}


def test_identities(make_turns):
    pairs = [
        ("mail", "Ann <A.B@x.example>", "mailto:a.b@X.example"), ("Mail ", "a.b@x.example ", '"B, A" <a.b@x.example>'), ("imessage", "iMessage;-;+999001", "SMS;-;00 999-001"), ("imessage", "RCS;-; A@B.example", "imessage;-;mailto:a@b.example"),
        ("claude_code", "/h/a/./s/x.jsonl", "\\h\\t\\..\\a\\\\s\\x.jsonl"), ("claude_code", "file:///h/b//x.jsonl", "/h/b/x.jsonl"), ("git_repos", "/srv/r.git", "/srv//r/.git"), ("git_repos", "/srv/q/", "/srv/q"),
    ]
    for s, a, b in pairs:
        assert related(make_turns, [{"source": s, "thread_id": a}, {"source": s, "thread_id": b}]) == {tuple(sorted((a, b)))}, (a, b)
    for s, a, b in [("claude_code", "/h/A/x", "/h/a/x"), ("mail", "a@x.example", "not-a@x.example"), ("imessage", "iMessage;+;chat1", "SMS;+;chat1"), ("perplexity", "A", "a"), ("git_repos", "/srv/r-1", "/srv/r")]:
        assert related(make_turns, [{"source": s, "thread_id": a}, {"source": s, "thread_id": b}]) == set(), (a, b)


def test_three_shared_turns_and_chains(make_turns):
    ts = [f"2024-01-0{i}T00:00:00" for i in range(1, 9)]
    from datetime import datetime

    row = lambda th, i, t=None: {"source": "chatgpt", "thread_id": th, "ts": datetime.fromisoformat(ts[i]), "text": t or f"m{i}"}
    rows = [row("a", i) for i in range(4)] + [row("b", i) for i in (1, 2, 3, 4, 5, 6)] + [row("c", i) for i in (4, 5, 6)] + [row("d", i) for i in (0, 1)] + [row("d", 2, " "), row("d", 2, " ")] + [row("e", i, "other") for i in range(4)] + [row("d", 0)] + [row(None, i) for i in range(4)]
    assert related(make_turns, rows) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert related(make_turns, rows[:0]) == set()


def test_shared_turns_match_brute_force(make_turns):
    r = random.Random(9)
    from datetime import datetime

    rows, have = [], {}
    for th in range(30):
        for i in r.sample(range(25), r.randrange(1, 9)):
            i = 0 if r.random() < 0.4 else i
            have.setdefault(f"t{th:02}", set()).add(i)
            rows.append({"source": "chatgpt", "thread_id": f"t{th:02}", "ts": datetime(2024, 1, 1 + i), "text": f"m{i}"})
    parent = {t: t for t in have}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in have:
        for b in have:
            if a < b and len(have[a] & have[b]) >= 3:
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    assert related(make_turns, rows) == {(a, b) for a in have for b in have if a < b and root(a) == root(b)}


def test_quotas():
    got = splits.solve_quotas([("x", 1, 1000), ("x", 300, 1), ("y", 5, 200), ("z", 7, 3)], {"train": 0.8, "validation": 0.1, "test": 0.1})
    assert all(sum(v.values()) == n for (p, s, n), v in zip([("x", 1, 1000), ("x", 300, 1), ("y", 5, 200), ("z", 7, 3)], [got["x", 1], got["x", 300], got["y", 5], got["z", 7]]))
    assert got["x", 300] == {"test": 0, "train": 1, "validation": 0}
    rows = {s: sum(got[p, k][s] * k for p, k in got) for s in ("train", "validation", "test")}
    assert abs(rows["validation"] - 232) <= 8 and abs(rows["test"] - 232) <= 8
    assert splits.solve_quotas([], {"a": 1.0}) == {} and splits.solve_quotas([("x", 1, 1)], {}) == {}


def test_flow_takes_the_cheap_way():
    g = splits.Flow(4)
    cheap, dear = g.add(0, 1, 3, 1), g.add(0, 2, 9, 5)
    g.add(1, 3, 3, 0), g.add(2, 3, 4, 0)
    assert g.run(0, 3) == 3 * 1 + 4 * 5 and g.arcs[cheap ^ 1][1] == 3 and g.arcs[dear ^ 1][1] == 4


def test_assignment(spark, make_turns):
    rows = [{"source": "mail", "thread_id": f"p{i}@x.example"} for i in range(200)] + [{"source": "mail", "thread_id": f"P{i}@X.example"} for i in range(200)] + [{"thread_id": None}, {"source": None, "thread_id": "q"}]
    t = make_turns(rows)
    goal = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1), ("none", 0.0), (None, 0.5)], "split_name string, target_share double")
    a = splits.assign_splits(t, goal)
    got = {r["turn_id"]: r["split_name"] for r in a.collect()}
    assert len(got) == 402 == a.count() and all(got[i] == got[i + 200] for i in range(1, 201))
    n = {s: sum(v == s for v in got.values()) for s in set(got.values())}
    assert abs(n["train"] - 322) <= 4 and abs(n["test"] - 40) <= 3
    assert got == {r["turn_id"]: r["split_name"] for r in splits.assign_splits(t.repartition(6), goal).collect()}
    rep = {r["split_name"]: r["n_turns"] for r in splits.split_report(t, goal).collect()}
    assert rep == n | {"none": 0}
    assert splits.assign_splits(t.limit(0), goal).count() == 0 and splits.assign_splits(t, goal.limit(0)).count() == 0


def test_rates():
    r = mixing.rates({"a": 100, "b": 1000, "c": 0}, {"a": (0.5, 2), "b": (0.4, 1), "c": (0.1, 9), "d": (0.0, 5)})
    assert r == {"a": 2.0, "b": 0.16}
    assert mixing.rates({}, {"a": (1.0, 1)}) == {}


def test_mix(spark, make_turns):
    rows = [{"source": " A ", "text": "x" * 10} for _ in range(400)] + [{"source": "b", "text": "y" * 10} for _ in range(50)] + [{"source": "a", "text": t} for t in (None, "")] + [{"source": None}] + [{"source": "B", "source_id": "401", "text": "y" * 10}] + [{"source": "b", "source_id": None, "text": "y" * 10}]
    t = make_turns(rows)
    goal = spark.createDataFrame([("a", 0.5, 1), ("B", 0.4, 3), ("gone", 0.1, 9), (None, 1.0, 1)], "source string, target_share double, max_repeats bigint")
    m = mixing.mix(t, goal)
    uses = {r["turn_id"]: r["c"] for r in m.groupBy("turn_id").agg(F.count("*").alias("c")).collect()}
    assert not uses.keys() & {451, 452, 453, 454} and 455 in uses
    assert all(c == 3 for i, c in uses.items() if i > 400) and len([i for i in uses if i > 400]) == 51 and all(c == 1 for i, c in uses.items() if i <= 400)
    rep = {r["source"]: r for r in mixing.mix_report(t, goal).collect()}
    assert rep["gone"]["n_uses"] == 0 and rep["b"]["most_uses"] == 3 and abs(rep["a"]["share"] - 5 / 9) < 0.06
    assert uses == {r["turn_id"]: r["c"] for r in mixing.mix(t.repartition(7), goal).groupBy("turn_id").agg(F.count("*").alias("c")).collect()}
    assert mixing.mix(t, goal, with_text=True).columns[-1] == "text"
    assert mixing.mix(t.limit(0), goal).count() == 0 and mixing.mix_report(t, goal.limit(0)).count() == 0


def test_best_fit_keeps_duplicates_apart():
    r = random.Random(5)
    size = [r.randint(0, 60) for _ in range(400)]
    cluster = [r.choice([None, *range(150)]) for _ in size]
    got = packing.best_fit(size, [i % 3 for i in range(400)], cluster, 100)
    used, seen = {}, set()
    for s, c, g in zip(size, cluster, got):
        used[g] = used.get(g, 0) + s
        assert c is None or (c, g) not in seen
        seen.add((c, g))
    assert max(used.values()) <= 100 and len(used) <= -(-sum(size) // 100) * 1.03 + 2
    hot = packing.best_fit([10] * 50, ["s"] * 50, [1] * 50, 100)
    assert len(set(hot)) == 5
    assert packing.best_fit([], [], [], 10) == []


@pytest.mark.skipif(not os.path.exists(packing.TOKENIZER), reason="no tokenizer file here")
def test_pack(spark):
    texts = ["word " * 300, "", None, "a b c", "a b c", "Ünï 🙂 code();\n\n  x" * 20, "tail  \n"]
    d = spark.createDataFrame([(i, t, None if i == 3 else "S", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, source string, shard int")
    b = spark.createDataFrame([("s", 64), ("l", 1000), ("bad", 0), (None, 5)], "budget_name string, capacity_tokens bigint")
    p = packing.pack(d, b).collect()
    import tiktoken

    enc = packing.Counter(open(packing.TOKENIZER, "rb").read()).enc
    assert isinstance(enc, tiktoken.Encoding)
    n = {i: len(enc.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    for name, cap in (("s", 64), ("l", 1000)):
        used = {}
        for i in n:
            mine = sorted((r["token_from"], r["token_to"]) for r in p if r["budget_name"] == name and r["doc_id"] == i)
            assert mine[0][0] == 0 and mine[-1][1] == n[i] and all(a[1] == z[0] for a, z in zip(mine, mine[1:])) and (len(mine) == 1) == (n[i] <= cap)
        for r in p:
            if r["budget_name"] == name:
                used[r["container_id"]] = used.get(r["container_id"], 0) + r["token_to"] - r["token_from"]
        assert max(used.values()) <= cap
    same = {r["doc_id"]: r["container_id"] for r in p if r["budget_name"] == "l"}
    assert same[3] != same[4] or sum(n.values()) <= 1000
    assert {r["budget_name"] for r in p} == {"s", "l"} and packing.pack(d.limit(0), b).count() == 0
    assert {r["budget_name"]: r["n_tokens"] for r in packing.pack_report(d, b).collect()} == {"s": sum(n.values()), "l": sum(n.values())}
