"""Messages read more than once that name several parents, and paths of branched threads."""

import json

from threadloom.llm import queries, threads

from .test_texts import envs


def chat(thread, name, i, parent=None, role=None):
    return ("chatgpt", name, i, json.dumps({"text": "t", "conversation_id": thread, "role": role or ("user" if i % 2 else "assistant"), "parent": parent}))


def test_every_parent_of_every_copy_counts(spark, make_turns):
    rows = []
    for k in range(12):
        t = f"T{k}"
        rows += [chat(t, f"{t}a", 1), chat(t, f"{t}b", 2, f"{t}a"), chat(t, f"{t}c", 3, f"{t}b"), chat(t, f"{t}c", 3, f"gone{k}")]
    rows += [chat("ok", "oa", 1), chat("ok", "ob", 2, "oa"), chat("ok", "oc", 3, "ob"), chat("ok", "oc", 3, "oa")]
    t = make_turns([{"source": "chatgpt", "thread_id": f"T{k}", "source_id": f"T{k}a", "text": "t"} for k in range(12)] + [{"source": "chatgpt", "thread_id": "ok", "source_id": "oa", "text": "t"}])
    v = {r["thread_id"]: r for r in threads.thread_verdicts(t, envs(spark, rows)).collect()}
    assert {k for k, r in v.items() if r["dropped"]} == {f"T{k}" for k in range(12)}
    assert all(v[f"T{k}"]["n_orphans"] == 1 for k in range(12)) and v["ok"]["n_orphans"] == 0
    assert len(threads.conversations(t, envs(spark, rows)).collect()) == 3


def test_paths_of_a_branched_thread(spark, make_turns):
    rows = [chat("B", "r", 1), chat("B", "x", 2, "r"), chat("B", "y", 3, "x"), chat("B", "z", 4, "x"), chat("B", "lone", 5), *[chat("B", f"n{i}", 6 + i, f"n{i - 1}" if i else "z") for i in range(9)], chat("B", "c1", 30, "c2"), chat("B", "c2", 31, "c1")]
    t = make_turns([{"source": "chatgpt", "thread_id": "B", "source_id": "r", "text": "t"}])
    got = {}
    for r in threads.paths(t, envs(spark, rows)).collect():
        got.setdefault(r["leaf"], []).append((r["seq"], r["source_id"]))
    assert {k: [x for _, x in sorted(v)] for k, v in got.items()} == {"y": ["r", "x", "y"], "lone": ["lone"], "n8": ["r", "x", "z", *[f"n{i}" for i in range(9)]]}
    assert [s for s, _ in sorted(got["n8"])] == list(range(1, 13))
    assert threads.paths(t.limit(0), envs(spark, rows).limit(0)).count() == 0


def test_sql_is_there_for_the_threads():
    assert {"p7_found", "p7_conversations", "p7_paths"} <= queries.oracle_sql().keys()
