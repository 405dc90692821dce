"""Typed text by its JSON type, private identity, paths, ordered reads and branch walks."""

import json
import os
import stat
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from threadloom.operators import provenance
from threadloom.plans.corpus import CorpusStore, IdentityStore, Ledger, UnknownVersion, Vault, ingest, shown, split_summary, without_paths
from threadloom.sources import connectors as C

NOW = datetime(2026, 1, 1, tzinfo=timezone.utc)


def test_typed_text_is_told_from_parts_by_type(spark, tmp_path):
    say = lambda c: json.dumps({"type": "user", "message": {"role": "user", "content": c}})
    rows = ["plain", '[{"type": "tool"}]', '[{"a": 1}] and prose behind it', [{"type": "text", "text": "part"}, {"type": "tool_result", "content": "no"}], [{"type": "text"}], 5, None, {"type": "text", "text": "no list"}]
    (tmp_path / "t.jsonl").write_text("".join(say(r) + "\n" for r in rows) + "[1]\n\"user\"\n")
    e, _ = C.transcripts(spark, str(tmp_path), "s", NOW)
    assert sorted(json.loads(r["payload"])["text"] for r in e.collect()) == sorted([rows[0], rows[1], rows[2], "part"])


def test_graph_parts_are_told_by_type(spark, tmp_path):
    part = '{"content_type": "image_asset_pointer"} typed by hand'
    node = lambda parts: {"parent": None, "message": {"id": "m", "author": {"role": "user"}, "content": {"content_type": "multimodal_text", "parts": parts}, "create_time": 5.0}}
    (tmp_path / "g.json").write_text(json.dumps([{"conversation_id": "c", "current_node": "n", "mapping": {"n": node([part, {"content_type": "image_asset_pointer", "x": 1}, {"content_type": "other"}])}}]))
    e, _ = C.graph_export(spark, str(tmp_path / "g.json"), "s", NOW)
    p = json.loads(e.first()["payload"])
    assert p["text"] == part and p["image_count"] == 1


def test_identity_is_private_and_resolves(spark, tmp_path):
    s = IdentityStore(spark, str(tmp_path / "id"))
    key = s.key()
    assert len(key) == 32 and IdentityStore(spark, str(tmp_path / "id")).key() == key
    assert stat.S_IMODE(os.stat(tmp_path / "id").st_mode) == 0o700 and stat.S_IMODE(os.stat(tmp_path / "id" / "identity_key").st_mode) == 0o600
    assert s.resolve("P-1") is None
    people = spark.createDataFrame([("P-1", "ann"), ("P-2", "bo"), ("P-1", "ann")], "pseudonym string, raw string")
    for _ in range(2):
        s.add(people)
    assert s.resolve("P-1") == "ann" and s.resolve("P-9") is None and s._map().count() == 2


def test_paths_are_not_shown(spark, tmp_path):
    assert shown("/home/x/repo/probes/f.json", "/home/x/repo") == "probes/f.json" and shown("/etc/secret/f.json", "/home/x") == "f.json"
    assert without_paths("cannot read '/home/x/a b' or file:/data/y/z.json: 1/2 of http://h/p") == "cannot read 'a b' or z.json: 1/2 of http://h/p"
    led = Ledger(str(tmp_path / "l.jsonl"))

    class None_:
        get = staticmethod(lambda s: None)

    def fails(_):
        raise OSError("no such file /home/someone/exports/chat.db")

    with pytest.raises(OSError):
        ingest(Vault(spark, str(tmp_path / "v")), None_, led, "mail", "s", fails)
    assert json.loads(led.read(spark).first()["payload"])["error"] == "no such file chat.db"


def test_split_summary_and_ordered_reads(spark, tmp_path):
    store = CorpusStore(spark, str(tmp_path / "c"))
    t = spark.createDataFrame([("m", str(i), f"t{i}", datetime(2026 if i > 7 else 2024, 1, 10 - i), False) for i in range(9)], "source string, source_id string, thread_id string, ts timestamp, assisted boolean")
    store.write("v1", t)
    r = split_summary(store, "v1", F.lit(datetime(2026, 2, 1)).cast("timestamp")).first()
    assert r["total"] == 9 == r["train"] + r["heldout"] + r["quarantined"] and r["quarantined"] == 1
    assert [x["source_id"] for x in store.read("v1", ordered=True).collect()] == ["7", "6", "5", "4", "3", "2", "1", "0", "8"]
    with pytest.raises(UnknownVersion):
        split_summary(store, "v2", F.lit(None).cast("timestamp"))


def test_branches_as_rows_and_as_maps(spark):
    n = [("a", f"n{i}", f"n{i - 1}" if i else None) for i in range(40)] + [("a", "side", "n3"), ("b", "x", "y"), ("b", "y", "x"), ("c", "only", "gone"), ("d", "self", "self")]
    nodes = spark.createDataFrame(n, "conversation_id string, id string, parent string")
    cur = spark.createDataFrame([("a", "n39"), ("b", "x"), ("c", "only"), ("d", "self"), ("e", "none"), ("a2", None)], "conversation_id string, id string")
    rows = {}
    for r in provenance.live_branch_rows(nodes, cur).collect():
        rows.setdefault(r["conversation_id"], []).append((r["pos"], r["id"]))
    want = {"a": [f"n{i}" for i in range(40)], "b": ["y", "x"], "c": ["only"], "d": ["self"]}
    assert {k: [x for _, x in sorted(v)] for k, v in rows.items()} == want
    m = nodes.groupBy("conversation_id").agg(F.map_from_entries(F.collect_list(F.struct("id", F.struct("parent")))).alias("mapping"))
    m = cur.withColumnRenamed("id", "current_node").join(m, "conversation_id", "left")
    got = {r["conversation_id"]: r["branch"] for r in provenance.live_branch(m).collect()}
    assert {k: v for k, v in got.items() if v} == want
