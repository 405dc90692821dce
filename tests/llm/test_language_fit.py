"""Rejection and confidence set from held-out sentences."""

import random

import numpy as np

from threadloom.llm import language as L

from .test_texts import SAY


def _units(r, n):
    return [(i, r.choices(SAY[x], k=12)) for i, x in enumerate(L.LANGS) for _ in range(n)]


def test_mean_confidence_is_the_share_of_right_ones():
    r = random.Random(1)
    model = L.KneserNey(L._counts(iter(_units(r, 30))))
    held = _units(r, 30)
    noisy = [((i + 1) % len(L.LANGS) if k % 5 == 0 else i, ws) for k, (i, ws) in enumerate(held)]
    reject, sharp = L.calibrated(model, noisy)
    ce = np.array([-model.scores(ws).sum(0) / sum(len(w) + 1 for w in ws) for _, ws in noisy])
    right = ce.argmin(1) == np.array([i for i, _ in noisy])
    conf = 1 / np.exp(-sharp * (ce - ce.min(1, keepdims=True))).sum(1)
    assert 0.7 < right.mean() < 0.85 and abs(conf.mean() - right.mean()) < 0.01
    assert abs(reject - L.REJECT * np.median(ce.min(1)[right])) < 1e-6
    assert -model.scores(["xqzkvw", "zzkqj"]).sum(0).max() / 13 > np.median(ce.min(1)) * 1.5


def test_without_held_out_sentences_the_defaults_stay():
    m = L.KneserNey(L._counts(iter(_units(random.Random(2), 3))))
    assert L.calibrated(m, []) == (L.KneserNey.reject, L.KneserNey.sharp)


def test_sample_is_the_same_in_any_order(spark):
    rows = [(i, x, " ".join(random.Random(i).choices(SAY[x], k=40)), "s") for x in L.LANGS for i in range(L.LANGS.index(x) * 20, L.LANGS.index(x) * 20 + 20)]
    d = spark.createDataFrame(rows, "doc_id bigint, lang string, text string, source string")
    a, b = L.fit(d, 10), L.fit(d.orderBy("text").repartition(5), 10)
    assert (a.reject, a.sharp) == (b.reject, b.sharp) and all(np.array_equal(x[0], y[0]) for x, y in zip(a.disc[1:], b.disc[1:]))
