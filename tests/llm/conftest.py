import random
from datetime import datetime, timedelta, timezone

import pytest

T0 = datetime(2024, 5, 1, tzinfo=timezone.utc)
TURN = "turn_id bigint, subject_id string, source string, source_id string, thread_id string, ts timestamp, author_id string, is_subject boolean, text string, assisted boolean, corpus_version string, eval_split string, cls int, block string, key string, n int"


@pytest.fixture(scope="session")
def make_turns(spark):
    """Turns from dicts; columns not given have plain values, and some extra ones clash with names used inside."""

    def make(rows):
        out = []
        for i, r in enumerate(rows):
            d = {"turn_id": i + 1, "subject_id": "s", "source": "mail", "source_id": str(i + 1), "thread_id": "t", "ts": T0 + timedelta(minutes=i), "author_id": "a", "is_subject": True, "text": "x", "assisted": False, "corpus_version": "v1", "eval_split": "train", "cls": 1, "block": "b", "key": "k", "n": 5} | r
            out.append(tuple(d.values()))
        return spark.createDataFrame(out, TURN)

    return make


@pytest.fixture(scope="session")
def prose():
    """Random texts of distinct made-up words and their edited copies."""
    r = random.Random(4)
    vocab = ["".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(3)) for _ in range(3000)]

    class Prose:
        def text(self, n=40):
            return " ".join(r.sample(vocab, n))

        def edit(self, text, k=2):
            w = text.split()
            for _ in range(k):
                w[r.randrange(len(w))] = r.choice(vocab)
            return " ".join(w)

    return Prose()
