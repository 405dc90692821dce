import statistics
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadloom.operators import evaluation as ev
from threadloom.operators import provenance, style
from threadloom.operators import turns as ops
from threadloom.operators.graph import connected_components

T0 = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
SCHEMA = "source_id string, thread_id string, ts timestamp, author_id string, is_subject boolean, text string, extra int"


def turns(spark, rows):
    return spark.createDataFrame([(str(i), th, T0 + timedelta(minutes=m), "me" if me else "other", me, tx, 1) for i, (th, m, me, tx) in enumerate(rows)], SCHEMA)


def contexts(d):
    return {r["text"]: [c["text"] for c in r["context"]] for r in d.collect()}


def test_reply_gap_is_inclusive_and_cap_comes_first(spark):
    d = turns(spark, [("a", 0, False, "q"), ("a", 180, True, "in"), ("b", 0, False, "q"), ("b", 181, True, "out")])
    assert contexts(ops.reply_pairs(d)) == {"in": ["q"]}
    d = turns(spark, [("a", 0, False, "other")] + [("a", i, True, f"m{i}") for i in range(1, 9)])
    got = contexts(ops.reply_pairs(d))
    assert "m6" in got and "m7" not in got and len(got["m6"]) == 6


def test_reply_null_threads_and_flags(spark):
    d = turns(spark, [(None, 0, False, "q"), (None, 1, True, "r"), ("a", 0, None, "who"), ("a", 1, True, "x")])
    assert contexts(ops.reply_pairs(d)) == {"x": ["who"]}
    assert ops.reply_pairs(d.limit(0)).count() == 0


def test_split_is_total_and_quarantine_strict(spark):
    now = T0 + timedelta(days=84)
    d = turns(spark, [("chat-7", 0, True, "a"), ("thread-0", 1, True, "b"), (None, 0, True, "c")])
    got = {r["text"]: r["split"] for r in ops.split_corpus(d, F.lit(now)).collect()}
    assert got == {"a": "train", "b": "quarantined", "c": "train"}


def test_normalize(spark):
    rows = [
        ("s", "imessage", "1", '{"text": " hi ", "is_from_me": true, "chat_guid": "c"}'), ("s", "imessage", "2", '{"text": "yo", "is_from_me": false, "chat_guid": "unknown"}'), ("s", "mail", "3", '{"text": "\\u00a0"}'),
        ("s", "chatgpt", "4", '{"text": "broken'), ("s", " Mail ", "5", '{"text": "m", "to": "x@y.z"}'), ("s", "mail", "6", None),
    ]
    e = spark.createDataFrame([(*r[:3], T0, r[3]) for r in rows], "subject_id string, source string, source_id string, ts timestamp, payload string")
    got = {r["source_id"]: (r["thread_id"], r["author_id"], r["is_subject"], r["text"]) for r in ops.normalize(e).collect()}
    assert got == {"1": ("c", "s", True, "hi"), "2": ("imessage:orphan:2", "unknown", False, "yo"), "5": ("x@y.z", "s", True, "m")}
    with pytest.raises(Exception):
        ops.normalize(e.withColumn("source", F.lit("fax"))).collect()


def test_vault_keeps_the_first(spark):
    e = spark.createDataFrame([("s", "m", "1", 2, "b"), ("s", "m", "1", 1, "a"), ("s", "m", "2", 1, "c")], "subject_id string, source string, source_id string, ingested_at int, payload string").withColumn("ts", F.lit(T0))
    got = {r["source_id"]: r["payload"] for r in ops.vault_dedupe(e).collect()}
    assert got == {"1": "a", "2": "c"}
    assert ops.new_to_vault(e, e).count() == 0


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14)), max_size=25))
def test_components_match_union_find(spark, pairs):
    parent = list(range(15))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    used = {x for p in pairs for x in p if p[0] != p[1]}
    e = spark.createDataFrame([*pairs, (None, 3)], "src int, dst int").repartition(3)
    got = {r["node"]: r["component"] for r in connected_components(e).collect()}
    assert got == {x: min(y for y in used if root(y) == root(x)) for x in used}


def test_component_of_a_long_chain(spark):
    e = spark.range(200).select(F.format_string("n%03d", "id").alias("src"), F.format_string("n%03d", F.col("id") + 1).alias("dst")).repartition(7)
    got = connected_components(e).collect()
    assert len(got) == 201 and {r["component"] for r in got} == {"n000"}


def test_fingerprint_matches_a_model(spark):
    texts = ["Hello, the world!", "", "I am HERE — so it is", None, "🙂🙂 ok"]
    d = spark.createDataFrame([(x,) for x in texts], "text string")
    r = style.fingerprint(d).first().asDict()
    t = [x or "" for x in texts]
    lens = [len(x) for x in t]
    words = [w for x in t for w in (w.lower().strip(".,;:!?—-()[]\"'") for w in x.split()) if w]
    assert r["n"] == 5 and r["mean_len"] == pytest.approx(statistics.fmean(lens)) and r["median_len"] == statistics.median(lens)
    assert r["len_stdev"] == pytest.approx(statistics.pstdev(lens)) and r["type_token_ratio"] == pytest.approx(len(set(words)) / len(words))
    assert r["fw:the"] == pytest.approx(words.count("the") / len(words)) and r["emoji_rate"] == pytest.approx(2 / sum(lens))
    z = style.fingerprint(d.limit(1).withColumn("text", F.lit(""))).first()
    assert z["len_stdev"] == 0 and z["type_token_ratio"] == 0 and z["burstiness"] == 0


def test_bands(spark):
    few = turns(spark, [("a", i, True, "x") for i in range(5)])
    assert style.self_distance_band(few, 4).first()["reason"] == "too few turns"
    single = turns(spark, [("a", i, True, "x y") for i in range(20)])
    assert "two halves" in style.self_distance_band(single, 4).first()["reason"]
    two = turns(spark, [(t, i, True, f"x y {i}") for t in "ab" for i in range(10)])
    assert "one split" in style.self_distance_band(two, 4).first()["reason"]
    many = turns(spark, [(f"t{t}", i, True, "word " * (t + i)) for t in range(8) for i in range(6)])
    a = style.self_distance_band(many, 12, 1).first()
    b = style.self_distance_band(many.orderBy(F.desc("ts")).repartition(5), 12, 1).first()
    assert a["reason"] == "" and a["median"] == pytest.approx(b["median"]) and a["p95"] >= a["median"] and a["partitions"] > 1
    assert style.corpus_distance(many, many, style.self_distance_band(many, 12, 1), 3).first()["distance"] > 0


def test_cap_and_sample(spark):
    d = turns(spark, [("big", i, True, "x") for i in range(10)] + [("small", 0, True, "x")])
    assert style.thread_mass_cap(d).first()["cap"] == 6 and style.thread_mass_cap(d.limit(0)).first()["cap"] == 0
    assert {r["thread_id"]: r["count"] for r in style.mass_balanced_sample(d).groupBy("thread_id").count().collect()} == {"big": 6, "small": 1}


def test_trials_do_not_depend_on_order(spark):
    p = spark.createDataFrame([(f"t{i % 3}", "s", str(i), ["c"], f"r{i}") for i in range(9)], "thread_id string, source string, source_id string, context array<string>, text string")
    c = p.select("source", "source_id", F.lit("fake").alias("candidate"))
    a = sorted(map(tuple, ev.build_trials(p, c, 5).select("trial_id", "real_is_a").collect()))
    assert a == sorted(map(tuple, ev.build_trials(p.orderBy(F.desc("source_id")).repartition(4), c, 5).select("trial_id", "real_is_a").collect())) and len(a) == 3
    t = ev.build_trials(p, c, 5)
    s = ev.score_trials(t, t.select("trial_id", F.when(F.col("real_is_a"), " A").otherwise("b").alias("guess"))).first()
    assert s["n"] == s["correct"] == 3 and s["accuracy"] == 1.0
    assert ev.score_trials(t, t.select("trial_id", F.lit("?").alias("guess"))).first()["correct"] == 0
    assert ev.score_trials(t.limit(0), t.select("trial_id", F.lit("a").alias("guess"))).first()["accuracy"] is None
    with pytest.raises(Exception):
        ev.score_trials(t.unionAll(t), t.select("trial_id", F.lit("a").alias("guess"))).collect()


def test_fact_scores(spark):
    p = spark.createDataFrame([("1", "q", "Yes", True), ("2", "q", "", False), ("3", "q", None, False)], "probe_id string, question string, expected string, answerable boolean")
    a = spark.createDataFrame([("1", " yes "), ("2", "made up"), ("3", "")], "probe_id string, answer string")
    assert ev.score_facts(p, a).first().asDict() == {"n": 3, "correct": 2, "fabrications": 1, "accuracy": 2 / 3}
    with pytest.raises(Exception):
        ev.score_facts(p, a.where("probe_id <> '3'")).collect()
    assert ev.score_facts(p.limit(0), a).first()["accuracy"] == 0.0
    r = spark.createDataFrame([("1", True), ("2", False)], "probe_id string, should_decline boolean")
    o = spark.createDataFrame([("1", True), ("2", True)], "probe_id string, declined boolean")
    assert ev.score_refusals(r, o).first().asDict() == {"agreed": 1, "n": 2, "rate": 0.5}


@pytest.mark.parametrize("n,un,ok", [(199, 100, False), (200, 80, True), (200, 79, False), (200, 120, True), (200, 121, False)])
def test_fact_gate_edges(spark, n, un, ok):
    letters = "abcdefghijklmnopqrstuvwxyz"
    p = spark.createDataFrame([(f"is {letters[i % 26]}{letters[i // 26 % 26]} so?", i >= un) for i in range(n)], "question string, answerable boolean")
    assert ev.fact_gate(p).first()["passed"] is ok


def test_shape_gate(spark):
    p = spark.createDataFrame([("is it Foo?" if i < 31 else "is w" + "abcdefghijklmnopqrstuvwxyz"[i % 26] + "abcdefghij"[i // 26] + "?", i % 2 == 0) for i in range(200)], "question string, answerable boolean")
    assert ev.fact_gate(p).first()["note"] == "one question shape too common"


def test_absences_and_worksheet(spark):
    d = turns(spark, [("a", i, True, "foo was shipped" if i < 6 else "bar is nice") for i in range(12)])
    got = {(r["entity"], r["attribute"]): r["skipped"] for r in ev.absence_candidates(d, {"foo": "product", "bar": "product", "no": "tech"}).collect()}
    assert got["foo", "launch_date"] == "attribute found" and got["bar", "launch_date"] is None and got["no", "version"] == "too few hits"
    long = "i think " + "word " * 20
    w = turns(spark, [("a", 0, True, long), ("a", 1, True, long + "!"), ("a", 2, True, "i think my lawyer " + "w " * 60), ("a", 3, True, "short i think")])
    rows = ev.worksheet_lines(w, w.limit(0)).collect()
    assert [(r["category"], r["rank"], r["withheld"]) for r in rows] == [("opinions", 1, 1)] and rows[0]["line"].endswith("!")
    assert ev.worksheet_lines(w, w).count() == 0


def test_question_duplicates(spark):
    qs = ["How many users does Foo have?", "How many paying users does Foo have?", "Who is it", "", None]
    p = spark.createDataFrame(list(enumerate(qs)), "item_id bigint, question string")
    assert [(r["a"], r["b"]) for r in ev.near_duplicate_questions(p).collect()] == [(0, 1)]
    assert {r["item_id"]: r["kept"] for r in ev.intake(p).collect()} == {0: True, 1: False, 2: True, 3: True, 4: True}


def test_claims(spark):
    a = spark.createDataFrame([("1", "likes tea"), ("2", "zzz")], "claim_id string, text string")
    b = spark.createDataFrame([("Likes Teas",), ("something much longer than that",)], "text string")
    assert {r["claim_id"]: r["recurs"] for r in ev.claim_recurrence(a, b).collect()} == {"1": True, "2": False}
    assert {r["recurs"] for r in ev.claim_recurrence(a, b.limit(0)).collect()} == {False}


def test_ancestors(spark):
    e = spark.createDataFrame([("a", []), ("b", ["a"]), ("c", ["a"]), ("d", ["b", "c"]), ("x", ["y"]), ("y", ["x"])] + [(f"k{i:02}", [f"k{i - 1:02}"] if i else []) for i in range(20)], "entry_id string, parents array<string>")
    f = lambda s: {r["entry"]: r["depth"] for r in provenance.ancestors(e, spark.createDataFrame([(s,)], "start string")).collect()}
    assert f("d") == {"d": 0, "b": 1, "c": 1, "a": 2} and f("x") == {"x": 0, "y": 1} and f("k19")["k00"] == 19
    with pytest.raises(KeyError):
        f("nobody")


def test_live_branch(spark):
    node = lambda p: {"parent": p}
    rows = [("c1", "n3", {"n1": node(None), "n2": node("n1"), "n3": node("n2"), "dead": node("n1")}), ("cyc", "a", {"a": node("b"), "b": node("a")}), ("none", None, {"a": node(None)}), ("gone", "z", {"a": node(None)})]
    d = spark.createDataFrame(rows, "conversation_id string, current_node string, mapping map<string,struct<parent:string>>")
    assert {r[0]: r[1] for r in provenance.live_branch(d).collect()} == {"c1": ["n1", "n2", "n3"], "cyc": ["b", "a"], "none": [], "gone": []}
