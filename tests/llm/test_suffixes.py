"""What evaluation texts share with training texts, read off sorted suffixes."""

import random

import numpy as np
import pyarrow as pa
import pytest
from threadloom.llm import overlap, suffixes

RUN = suffixes.SHINGLE


def shared(a, b):
    """Longest common prefix."""
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def covered(text, train):
    """Words of the text in runs of eight or more that a training text has."""
    grams = {tuple(t[i : i + RUN]) for t in train for i in range(len(t) - RUN + 1)}
    return len({k for i in range(len(text) - RUN + 1) if tuple(text[i : i + RUN]) in grams for k in range(i, i + RUN)})


@pytest.fixture(scope="module")
def passages():
    """Training and evaluation texts that have passages of one another, most of them far from similar as a whole, some longer than what is sorted by."""
    r = random.Random(12)
    vocab = [f"w{i}" for i in range(400)]
    train = [[r.choice(vocab) for _ in range(r.choice((40, 90, 260)))] for _ in range(40)]
    evals = []
    for k in range(40):
        out = [r.choice(vocab) for _ in range(30)]
        for t in r.sample(train, k % 4):
            at = r.randrange(len(t) - 10)
            out += t[at : at + r.choice((7, 8, 9, 30, 200))] + [r.choice(vocab) for _ in range(k % 3)]
        evals.append(out)
    evals += [train[3], train[3] + train[5], [*train[7][:100], "x", *train[7][101:]]]
    return train, evals


def turns_of(make_turns, train, evals):
    return make_turns([{"text": " ".join(t)} for t in train] + [{"text": " ".join(t), "eval_split": "heldout"} for t in evals])


def check_covered(make_turns, train, evals):
    got = {r["turn_id"]: (r["n_words"], r["covered_words"]) for r in overlap.covered_turns(turns_of(make_turns, train, evals)).collect()}
    assert got == {len(train) + 1 + i: (len(t), covered(t, train)) for i, t in enumerate(evals)}


def test_covered_words_of_evaluation_turns(make_turns, passages):
    check_covered(make_turns, *passages)


def test_openings_that_many_texts_have(make_turns, passages, monkeypatch):
    for name, n in (("HOT", 6), ("SHARE", 10), ("SAMPLE", 1)):
        monkeypatch.setattr(suffixes, name, n)
    train, evals = passages
    head, only = [f"h{i}" for i in range(12)], [f"o{i}" for i in range(12)]
    train, evals = [head + t for t in train[:20]] + [only + t for t in train[20:]], [head + t if i % 2 else t for i, t in enumerate(evals)]
    t = turns_of(make_turns, train, evals).withColumn("side", overlap._side()).select("turn_id", "text", "side")
    seqs = t.mapInArrow(suffixes.sequences, suffixes.SEQUENCES).where("words is not null")
    hot, both = suffixes.Suffixes._hot(None, seqs)
    assert 0 < both.size < hot.size
    check_covered(make_turns, train, evals)


def test_covered_words_without_broadcasts(make_turns, passages, monkeypatch):
    from threadloom.llm import near

    monkeypatch.setattr(near, "BROADCAST_ROWS", -1)
    check_covered(make_turns, *passages)


def test_neighbours_have_the_longest_common_prefix(passages):
    r = random.Random(3)
    # few words, so that suffixes branch at every depth
    rows = [(i, i % 2 == 0, i % 2 == 1, [r.randrange(1, 3) for _ in range(r.randrange(8, 90))]) for i in range(60)]
    b = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["ext", "tr", "ev", "words"])
    (out,) = suffixes.adjacent(suffixes.suffix_tails(1)(iter([b])))
    got: dict = {}
    for x in out.to_pylist():
        assert rows[x["other"]][1] and rows[x["ext"]][2]
        got[x["ext"], x["at"]] = max(got.get((x["ext"], x["at"]), 0), x["len"])
    want = {}
    for i, _, ev, w in rows:
        for at in range(len(w) - RUN + 1) if ev else ():
            best = max(shared(w[at : at + suffixes.DEPTH], t[p : p + suffixes.DEPTH]) for _, tr, _, t in rows if tr for p in range(len(t) - RUN + 1))
            if best >= RUN:
                want[i, at] = best
    assert got == want


def test_pairs_come_from_adjacent_suffixes(make_turns):
    w = [f"w{i}" for i in range(300)]
    train, evals = [w[:100], w[100:200]], [w[50:58] + w[200:240], w[90:130], w[200:260], w[100:107] + w[260:300]]
    t = turns_of(make_turns, train, evals).withColumn("side", overlap._side()).select("turn_id", "text", "side")
    got = {tuple(r) for r in suffixes.Suffixes(t, cover=False).pairs.df.collect()}
    assert got == {(3, 1), (4, 1), (4, 2)}


def test_near_pairs_of_the_bands_and_of_the_suffixes_are_united(make_turns, monkeypatch):
    """With no bands at all the suffixes still give the pairs that have runs in common."""
    from threadloom.llm import near

    w = [f"w{i}" for i in range(200)]
    d = turns_of(make_turns, [w[:60], w[100:160]], [[*w[:55], "a"], [*w[103:160], "b"]])
    monkeypatch.setattr(near.Banded, "_pass", lambda self, *a, **k: near.Stage(self.spark.createDataFrame([], "a bigint, b bigint"), "none"))
    assert {tuple(r) for r in overlap.overlap_pairs(d).collect()} == {(1, 3), (2, 4)}


def test_report_has_the_covered_words(make_turns):
    w = [f"w{i}" for i in range(300)]
    train = [w[:100], w[100:130], w[:100]]
    evals = [[*w[:50], "x", *w[51:100]], [*w[:90], *w[120:130]]]
    (r,) = overlap.overlap_report(turns_of(make_turns, train, evals).selectExpr("* except (source)", "cast(null as string) as source")).collect()
    assert (r["n_pairs"], r["n_eval_turns"], r["n_train_turns"]) == (4, 2, 2)
    assert (r["n_eval_words"], r["n_covered_words"]) == (200, 99 + 100)


def test_no_turns(make_turns):
    d = turns_of(make_turns, [["a"] * 30], [[f"w{i}" for i in range(30)]])
    assert [tuple(r) for r in overlap.covered_turns(d).collect()] == [(2, 30, 0)]
    assert overlap.covered_turns(d.limit(0)).count() == overlap.overlap_report(d).count() == 0
    assert np.array_equal(suffixes.neighbours(np.array([0, 9, 8]), np.array([True, False, False]))[1], [0, 9, 8])
