"""Near texts that share no run of eight words."""

import random

import pytest
from threadloom.llm import neardup, overlap


def _scattered(vocab, n, step, r):
    """A text and its copy with every ``step``-th word replaced by a new one."""
    w = r.sample(vocab, n)
    return " ".join(w), " ".join(f"new{r.randrange(10**9)}" if i % step == step - 1 else x for i, x in enumerate(w))


@pytest.fixture(scope="module")
def pairs():
    r = random.Random(8)
    vocab = [f"w{i}" for i in range(20_000)]
    out = [_scattered(vocab, 24, 6, r) for _ in range(30)]  # 20 of 28 distinct words
    out += [_scattered(vocab, 1000, 7, r) for _ in range(5)]
    for _ in range(15):
        a = r.sample(vocab, 40)
        b = a[:]
        r.shuffle(b)
        out.append((" ".join(a), " ".join(b[:-1] + ["other"])))
    return out


def test_groups_of_scattered_and_reordered_texts(make_turns, pairs):
    d = make_turns([{"text": t} for p in pairs for t in p])
    want = {(2 * i + 1, 2 * i + k) for i in range(len(pairs)) for k in (1, 2)}
    assert {tuple(r) for r in neardup.near_duplicate_groups(d).collect()} == want


def test_overlaps_of_scattered_and_reordered_texts(make_turns, pairs):
    d = make_turns([{"text": t, "eval_split": ("train", "heldout")[k]} for p in pairs for k, t in enumerate(p)])
    assert {tuple(r) for r in overlap.overlap_pairs(d).collect()} == {(2 * i + 1, 2 * i + 2) for i in range(len(pairs))}


def test_covered_words_are_counted_exactly(make_turns):
    w = [f"w{i}" for i in range(100)]
    rows = [w, w[:41] + ["x"] + w[42:50] + ["y"] + w[51:], w[:30], [*w[23:30], *w[:23]]]
    d = make_turns([{"text": " ".join(t), "eval_split": "train" if i % 2 else "heldout"} for i, t in enumerate(rows)])
    got = {(r["eval_turn"], r["train_turn"]): r["covered"] for r in overlap.cross_split_overlaps(d).collect()}
    assert got == {(1, 2): 41 + 8 + 49, (3, 4): None}
