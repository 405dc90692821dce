import pytest
from pyspark.sql import functions as F

from threadloom.operators import style

ROW = "turn_id bigint, thread_id string, text string"


def some_turns(spark, tag="t"):
    rows = [(1000 * t + i, f"{tag}{t}", " ".join(f"w{(t * k + i) % 17} the" for k in range((t + i) % 5)) or None) for t in range(9) for i in range(2 + 3 * (t % 4))]
    return spark.createDataFrame([*rows, (1, None, "no thread")], ROW)


def rows(fp, *keys):
    return {tuple(r[k] for k in keys): [r["n"], *[pytest.approx(r[f]) for f in style.FIELDS]] for r in fp.collect()}


def test_the_plan_of_a_distance_stays_small(spark):
    """The driver holds every exchange with its plan: 200 trials once were 117 of them."""
    d = some_turns(spark)
    plan = style.corpus_distance(d, some_turns(spark, "o"), style.self_distance_band(d, 8, 0, "turn_id"), 3, 0, "turn_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 20 and "regexp" not in plan


def test_prints_of_draws_equal_those_of_their_rows(spark):
    d, draws = some_turns(spark), 70
    model = style._fingerprint(style.measured(style.mass_balanced_sample(d, 3, "turn_id", draws)), "trial")
    got = rows(style._drawn_fingerprints(d, draws, 3, "turn_id"), "cell")
    assert len(got) == draws and got == rows(model, "trial")


def test_prints_of_halves_equal_those_of_their_rows(spark):
    d, trials = some_turns(spark), 70
    sample = style.mass_balanced_sample(d, 3, "turn_id", trials)
    sides = style.balanced_halves(sample.groupBy("trial", "thread_id").agg(F.count("*").alias("size")), 3).localCheckpoint()
    fp = style.trial_fingerprints(d, trials, 3, "turn_id")
    got = rows(fp, "trial", "side")
    assert len(got) == 2 * trials and got == rows(style._fingerprint(style.measured(sample.join(sides, ["trial", "thread_id"])), "trial", "side"), "trial", "side")
    left = sides.groupBy("trial").agg(F.collect_list(F.struct("thread_id", "side")).alias("s")).collect()
    sets = {r["trial"]: frozenset(frozenset(x["thread_id"] for x in r["s"] if x["side"] == s) for s in ("left", "right")) for r in left}
    splits = {r["trial"]: tuple(r["split"]) for r in fp.select("trial", "split").collect()}
    assert len(set(zip(sets.values(), (splits[t] for t in sets)))) == len(set(sets.values())) == len(set(splits.values()))
