import itertools
import os
import random

import numpy as np
import pytest

from threadloom.llm import neardup, overlap
from threadloom.llm import words as W
from threadloom.llm.trie import trie_join


def near(a, b):
    x, y = set(W.words(a)), set(W.words(b))
    return len(x) >= 24 and len(y) >= 24 and len(x & y) >= 0.7 * len(x | y)


def groups(rows):
    """Brute force: (group_id, turn_id)."""
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    hit = set()
    for (i, a), (j, b) in itertools.combinations(rows, 2):
        if a and b and near(a, b):
            hit |= {i, j}
            p, q = sorted((root(i), root(j)))
            parent[q] = p
    return {(root(i), i) for i in hit}


def test_trie_join_is_exact():
    r = np.random.default_rng(1)
    n = 600
    block = r.integers(0, 4, n)
    base = r.integers(0, 2**63, (6, 2), dtype=np.int64)
    s = base[r.integers(0, 6, n)].copy()
    for i in range(n):
        for _ in range(r.integers(0, 40)):
            s[i, r.integers(0, 2)] ^= np.int64(1) << np.int64(r.integers(0, 62))
    part = r.integers(0, 2, n)
    pop = lambda i, j: sum(int(x).bit_count() for x in (s[i].view(np.uint64) ^ s[j].view(np.uint64)))
    for p in (None, part):
        got = sorted(tuple(sorted((int(a), int(b)))) for i, j in trie_join(block, s[:, 0], s[:, 1], 30, p) for a, b in zip(i, j))
        want = sorted((i, j) for i, j in itertools.combinations(range(n), 2) if block[i] == block[j] and pop(i, j) <= 30 and (p is None or p[i] != p[j]))
        assert got == want
    comp, left, right = r.integers(0, 5, n), r.integers(0, 2, n), r.integers(0, 2, n)
    got = sorted(tuple(sorted((int(a), int(b)))) for i, j in trie_join(block, s[:, 0], s[:, 1], 30, None, comp, left, right) for a, b in zip(i, j))
    assert got == sorted((i, j) for i, j in itertools.combinations(range(n), 2) if block[i] == block[j] and pop(i, j) <= 30 and comp[i] != comp[j] and (left[i] & right[j] or right[i] & left[j]))
    same = np.zeros(n, np.int64)
    assert list(trie_join(block, s[:, 0], s[:, 1], 128, None, same)) == []
    assert list(trie_join(block[:0], s[:0, 0], s[:0, 1], 3, None, same[:0])) == []


def test_minhashes_estimate_jaccard():
    r = np.random.default_rng(2)
    sizes = np.array([40, 24, 40, 300, 24, 1])
    flat = r.integers(0, 2**63, sizes.sum()).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    flat[starts[2] : starts[2] + 30] = flat[:30]
    low = W.minhashes(flat, starts, sizes, "b", 0, 2000)
    assert low.shape == (2000, 6)
    assert abs((low[:, 0] == low[:, 2]).mean() - 30 / 50) < 0.05 and not (low[:, 0] == low[:, 3]).any()
    h = (W.mix(flat, W.M3) >> np.uint64(32)).astype(np.uint32)
    assert low[7].tolist() == [int((h[s : s + n] * W._odd("b", 7)).min()) for s, n in zip(starts, sizes)]


def test_bands_miss_as_seldom_at_any_size():
    for n in (0, 1, 10**5, 10**7, 10**9, 10**12):
        rows, bands = W.band_plan(n, 0.7)
        assert (1 - 0.7**rows) ** bands <= W.MISS


def test_groups_match_brute_force(make_turns, prose):
    texts = [prose.text(30 + i % 20) for i in range(12)]
    rows = []
    for t in texts:
        rows += [t] + [prose.edit(t, k) for k in (1, 3)] + [t.upper() + "!"]
    w = texts[0].split()
    rows += [" ".join(w[15:] + w[:15]), " ".join(reversed(w)), "", None, "short text", "ünï " * 30, texts[1], "x" * 200_000]
    d = make_turns([{"text": t} for t in rows])
    got = {tuple(r) for r in neardup.near_duplicate_groups(d).collect()}
    assert got == groups(list(enumerate(rows, 1)))
    assert neardup.near_duplicate_groups(d.limit(0)).count() == 0
    assert {tuple(r) for r in neardup.near_duplicate_groups(d.orderBy("text").repartition(5)).collect()} == got


@pytest.fixture
def tiny_limits(monkeypatch):
    from threadloom.llm import near as N

    for name, n in (("HOT", 4), ("SHARE", 10), ("CHUNK", 5)):
        monkeypatch.setattr(N, name, n)
    return N


def test_hot_keys_are_cut_into_chunks(make_turns, prose, tiny_limits):
    head = prose.text(22)
    rows = [head + " " + prose.text(12) for _ in range(40)]
    rows += [prose.edit(t, 2) for t in rows[:20]]
    d = make_turns([{"text": t, "eval_split": "train" if i < 40 else "heldout"} for i, t in enumerate(rows)])
    t = d.withColumn("side", overlap._side()).select("turn_id", "text", "side")
    found = tiny_limits.Banded(t, cross=True)._hot()
    assert found and max(found.values()) > 2 * tiny_limits.CHUNK
    assert {tuple(r) for r in neardup.near_duplicate_groups(d).collect()} == groups(list(enumerate(rows, 1)))
    want = {(i + 1, j + 1) for i in range(40) for j in range(40, 60) if near(rows[i], rows[j])}
    assert {tuple(r) for r in overlap.overlap_pairs(d).collect()} == want


def test_hot_group_is_linked_by_stars(make_turns, prose, tiny_limits):
    base = prose.text(40)
    rows = [prose.edit(base, k % 9) for k in range(30)] + [" ".join(base.split()[:10]) + " " + prose.text(30) for _ in range(6)]
    d = make_turns([{"text": t} for t in rows])
    assert {tuple(r) for r in neardup.near_duplicate_groups(d).collect()} == groups(list(enumerate(rows, 1)))


def test_large_blocks_are_linked_to_centres_first(make_turns, prose, monkeypatch):
    from threadloom.llm import near as N

    monkeypatch.setattr(N, "STAR", 3)
    monkeypatch.setattr(N, "CENTRES", 2)
    head = prose.text(30)
    rows = [head + " " + prose.text(k % 14) for k in range(60)] + [prose.text(40) for _ in range(6)]
    rows += [prose.edit(t, 3) for t in rows[::3]]
    d = make_turns([{"text": t} for t in rows])
    assert {tuple(r) for r in neardup.near_duplicate_groups(d).collect()} == groups(list(enumerate(rows, 1)))


def test_records_follow_the_rows_where_a_third_is_one_group(make_turns, prose, tiny_limits):
    """Keys whose classes are linked to one centre send no record: as many rows of near copies as of others add none."""
    base = prose.text(60)
    other = [prose.text(60) for _ in range(40)]
    sent = []
    for extra in (0, 20):
        d = make_turns([{"text": t} for t in other + [base.replace(base.split()[k], f"one{k}") for k in range(extra)]])
        b = tiny_limits.Banded(d.selectExpr("turn_id", "text", "cast(null as int) as side"), cross=False)
        got = b.near()
        assert got.count() >= max(0, extra - 1)
        rows = b.features.df
        hot = np.array(sorted(b._hot()), np.int64)
        if extra:
            ends = b._ends(rows, hot.view(np.uint64), "comp")
            assert sum(lo == hi for lo, hi in ends.values()) > 0.8 * len(ends)
        sent.append(len(hot))
    assert sent[0] == 0 < sent[1]


def test_without_broadcasts(make_turns, prose, monkeypatch):
    from threadloom.llm import near as N

    monkeypatch.setattr(N, "BROADCAST_ROWS", -1)
    rows = [prose.text(40) for _ in range(10)]
    rows += [prose.edit(t, 2) for t in rows]
    d = make_turns([{"text": t, "eval_split": "train" if i < 10 else "heldout"} for i, t in enumerate(rows)])
    assert {tuple(r) for r in neardup.near_duplicate_groups(d).collect()} == groups(list(enumerate(rows, 1)))
    assert {tuple(r) for r in overlap.overlap_pairs(d).collect()} == {(i + 1, j + 1) for i in range(10) for j in range(10, 20) if near(rows[i], rows[j])}


def test_large_blocks_use_the_trie(make_turns, prose):
    base = prose.text(40)
    rows = [prose.edit(base, 2) for _ in range(60)]
    d = make_turns([{"text": t, "eval_split": "train" if i % 2 else "validation"} for i, t in enumerate(rows)])
    want = {(i + 1, j + 1) for i, j in itertools.combinations(range(60), 2) if i % 2 != j % 2 and near(rows[i], rows[j])}
    assert {tuple(r) for r in overlap.overlap_pairs(d).collect()} == want


def test_repeated_rows_count_once(make_turns, prose):
    a, b = prose.text(40), prose.text(40)
    one = [{"turn_id": 1, "text": a}, {"turn_id": 2, "text": prose.edit(a, 2), "eval_split": "heldout"}, {"turn_id": 3, "text": b}]
    d = make_turns([*one, *one, {"turn_id": None, "text": a}, {"turn_id": None, "text": a, "eval_split": "heldout"}])
    assert sorted(tuple(r) for r in neardup.near_duplicate_groups(d).collect()) == [(1, 1), (1, 2)]
    assert [tuple(r) for r in overlap.overlap_pairs(d).collect()] == [(1, 2)]


def test_overlaps(make_turns, prose):
    a = prose.text(40)
    rows = [
        {"text": a}, {"text": a, "eval_split": "Heldout "}, {"text": prose.edit(a, 2), "eval_split": "validation", "thread_id": "u"}, {"text": a, "eval_split": "quarantined"}, {"text": a, "eval_split": None},
        {"text": None, "eval_split": "heldout"}, {"text": "tiny", "eval_split": "heldout"}, {"text": "tiny"}, {"text": prose.text(40), "eval_split": "heldout"}, {"text": a},
    ]
    d = make_turns(rows)
    assert {tuple(r) for r in overlap.overlap_pairs(d).collect()} == {(1, 2), (1, 3), (2, 10), (3, 10)}
    rep = {r["eval_split"]: r for r in overlap.overlap_report(d).collect()}
    assert rep["heldout"]["n_pairs"] == 2 and rep["heldout"]["n_same_words"] == 2 and rep["validation"]["n_same_thread"] == 0
    full = overlap.cross_split_overlaps(d).where("not exact").collect()
    assert all(8 <= r["covered"] <= 40 and r["jaccard"] >= 0.7 for r in full)
    assert overlap.overlap_pairs(d.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables here")
def test_on_the_small_tables(spark):
    t = spark.read.parquet("/root/testdata/sf0.001/turns.parquet")
    rows = [(r["turn_id"], r["text"], r["eval_split"]) for r in t.select("turn_id", "text", "eval_split").collect()]
    assert {tuple(r) for r in neardup.near_duplicate_groups(t).collect()} == groups([r[:2] for r in rows])
    ev = ("validation", "heldout")
    want = {tuple(sorted((i, j))) for i, a, s in rows if s == "train" for j, b, q in rows if q in ev and a and b and near(a, b)}
    assert {tuple(r) for r in overlap.overlap_pairs(t).collect()} == want
