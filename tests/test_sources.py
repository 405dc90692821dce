import json
import os
import sqlite3
import subprocess
import zipfile
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from threadloom.plans.corpus import CorpusStore, Cursors, Ledger, UnknownVersion, Vault, VersionExists, build_corpus, freeze, ingest, load_golden, supersede
from threadloom.sources import connectors as C
from threadloom.sources import inputs
from threadloom.streaming.ingest import stream_envelopes, stream_transcripts, windowed_counts

NOW = datetime(2026, 1, 1, tzinfo=timezone.utc)


def payloads(df):
    return {r["source_id"]: json.loads(r["payload"]) for r in df.collect()}


def test_chat_database(spark, tmp_path):
    p = str(tmp_path / "chat.db")
    c = sqlite3.connect(p)
    c.executescript("create table message(guid text, text text, attributedBody blob, is_from_me int, date int, handle_id int); create table handle(id text); create table chat(guid text); create table chat_message_join(chat_id int, message_id int);")
    body = b"xxNSString\x01+\x04blob"
    c.executemany("insert into message values (?,?,?,?,?,?)", [("g", "hi", None, 1, 60, None), ("g", None, body, 0, 120_000_000_000_000, 1), ("g", " ", None, 0, 0, 1), ("g", "", b"junk", 0, 0, 1)])
    c.execute("insert into handle values ('+99')")
    c.executemany("insert into chat values (?)", [("zz",), ("aa",)])
    c.executemany("insert into chat_message_join values (?,?)", [(1, 1), (2, 1), (1, 2)])
    c.commit()
    c.close()
    got = payloads(C.chat_database(spark, p, "s", NOW))
    assert got == {"1": {"text": "hi", "is_from_me": True, "handle": "unknown", "chat_guid": "aa"}, "2": {"text": "blob", "is_from_me": False, "handle": "+99", "chat_guid": "zz"}}
    assert list(payloads(C.chat_database(spark, p, "s", NOW, after=1))) == ["2"]
    assert C.recovery(spark, p).first().asDict() == {"n_rows": 4, "n_blank": 3, "n_bodies": 2, "n_decoded": 1, "rate": 0.5, "passed": False}
    with pytest.raises(Exception):
        C.chat_database(spark, str(tmp_path / "none.db"), "s", NOW).collect()


def test_transcripts_resume_and_hold_back(spark, tmp_path):
    f = tmp_path / "a" / "t.jsonl"
    f.parent.mkdir()
    line = lambda t: json.dumps({"type": "user", "message": {"role": "user", "content": t}})
    f.write_text(line("one") + "\n" + "{bad\n" + json.dumps({"type": "assistant", "message": {"content": "no"}}) + "\n" + line([{"type": "text", "text": "two"}, {"type": "image"}, {"type": "text", "text": "```x```three"}]) + "\n" + line("par")[:-3])
    e, cur = C.transcripts(spark, str(tmp_path), "s", NOW)
    assert sorted(p["text"] for p in payloads(e).values()) == ["one", "two\nthree"]
    first = set(payloads(e))
    with open(f, "a") as h:
        h.write(line("par")[-3:] + "\n")
    e2, cur2 = C.transcripts(spark, str(tmp_path), "s", NOW, cur)
    assert [p["text"] for p in payloads(e2).values()] == ["par"] and not first & set(payloads(e2)) and cur2 != cur
    assert C.transcripts(spark, str(tmp_path), "s", NOW, cur2)[0].count() == 0


def test_exports(spark, tmp_path):
    conv = [{"uuid": "c1", "name": "n", "chat_messages": [
        {"uuid": "m1", "sender": "human", "text": " hi ", "created_at": "2025-01-02T03:04:05Z", "attachments": [{"extracted_content": "abc"}], "files": []}, {"uuid": "m2", "sender": "assistant", "text": "no"},
        {"uuid": "", "sender": "human", "text": "", "content": [{"type": "text", "text": "block"}]}]}]
    z = str(tmp_path / "e.zip")
    with zipfile.ZipFile(z, "w") as h:
        h.writestr("x/conversations.json", json.dumps(conv))
    e, cur = C.zip_export(spark, z, "s", NOW)
    got = payloads(e)
    assert got["m1"]["text"] == "hi" and got["m1"]["attachment_chars"] == 3 and len(got) == 2 and "block" in {p["text"] for p in got.values()}
    assert {str(r["ts"])[:10] for r in e.collect()} == {"2025-01-02", "2026-01-01"}
    assert C.zip_export(spark, z, "s", NOW, cur)[0].count() == 0
    q = tmp_path / "q.json"
    q.write_text(json.dumps({"conversations": [{"context_uuid": "x", "entries": [{"entry_uuid": "1", "query": "why", "query_status": "FAILED"}, {"entry_uuid": "2", "query": " "}]}]}))
    assert payloads(C.query_export(spark, str(q), "s", NOW)[0])["1"]["query_status"] == "FAILED"
    node = lambda parent, text, role="user", **k: {"parent": parent, "message": {"id": text, "author": {"role": role}, "content": {"content_type": "text", "parts": [text]}, **k}}
    g = tmp_path / "g.json"
    g.write_text(json.dumps([
        {"conversation_id": "a", "create_time": 5.0, "current_node": "n3", "mapping": {"n1": node(None, "q1"), "n2": node("n1", "ans", "assistant"), "n3": {"parent": "n2", "message": {"id": "img", "author": {"role": "user"}, "content": {"content_type": "multimodal_text", "parts": [{"content_type": "image_asset_pointer"}, "cap"]}, "create_time": 9.5}}, "dead": node("n1", "gone"), "sys": node("n1", "sys", metadata={"is_user_system_message": True})}},
        {"conversation_id": "loop", "current_node": "a", "mapping": {"a": node("b", "la"), "b": node("a", "lb")}}]))
    e = C.graph_export(spark, str(g), "s", NOW)[0]
    got = payloads(e)
    assert set(got) == {"q1", "img", "la", "lb"} and got["img"]["text"] == "cap" and got["img"]["image_count"] == 1
    assert {r["source_id"]: r["ts"].year for r in e.collect()}["la"] == 1970
    (tmp_path / "bad.json").write_text("{}")
    with pytest.raises(Exception):
        C.graph_export(spark, str(tmp_path / "bad.json"), "s", NOW)[0].collect()
    with pytest.raises(FileNotFoundError):
        C.graph_export(spark, str(tmp_path / "missing.json"), "s", NOW)


def test_mailboxes(spark, tmp_path):
    p = tmp_path / "m.mbox"
    msg = lambda frm, mid, body: f"From x Thu Jan  1 00:00:00 2024\nFrom: {frm}\nTo: b@y.example\nSubject: s\nDate: Mon, 01 Jan 2024 10:00:00 +0200\n" + (f"Message-ID: {mid}\n" if mid else "") + f"\n{body}\n\n"
    p.write_text(msg("Me <ME@x.example>", "<1>", "new\n> old") + msg("me@x.example.evil", "<2>", "no") + msg("me@x.example", "<1>", "again") + msg("me@x.example", None, "> only quoted"))
    e, cur = C.mailboxes(spark, str(p), ["me@x.example"], "s", NOW)
    got = payloads(e)
    assert {k: v["text"] for k, v in got.items()} == {"<1>": "new", f"{p}:2": "again"} and str(e.first()["ts"]) == "2024-01-01 08:00:00"
    assert C.mailboxes(spark, str(p), ["me@x.example"], "s", NOW, cur)[0].count() == 0


def test_git(spark, tmp_path):
    r = str(tmp_path / "r")
    run = lambda *a: subprocess.run(["git", "-C", r, *a], check=True, capture_output=True, env=os.environ | {"GIT_AUTHOR_NAME": "a", "GIT_COMMITTER_NAME": "a", "GIT_AUTHOR_EMAIL": "A@x.example", "GIT_COMMITTER_EMAIL": "a@x.example"})
    os.mkdir(r)
    run("init", "-q")
    assert C.git_log(spark, r, ["a@x.example"], "s", NOW)[0].count() == 0
    run("commit", "-q", "--allow-empty", "-m", "first\n\nbody")
    e, cur = C.git_log(spark, r, ["a@X.example"], "s", NOW)
    assert [p["text"] for p in payloads(e).values()] == ["first\n\nbody"]
    run("commit", "-q", "--allow-empty", "-m", "second")
    assert [p["text"] for p in payloads(C.git_log(spark, r, ["a@x.example"], "s", NOW, cur)[0]).values()] == ["second"]
    assert C.git_log(spark, r, ["a@x.example"], "s", NOW, json.dumps({r: "0" * 40}))[0].count() == 2
    with pytest.raises(Exception):
        C.git_log(spark, str(tmp_path), ["a@x.example"], "s", NOW)


def envelopes(spark, rows):
    d = spark.createDataFrame([("s", *r) for r in rows], "subject_id string, source string, source_id string, payload string")
    return d.withColumn("ts", F.lit(NOW)).withColumn("ingested_at", F.lit(NOW))


def test_ingest_build_and_golden(spark, tmp_path):
    vault, store = Vault(spark, str(tmp_path / "vault")), CorpusStore(spark, str(tmp_path / "corpus"))
    ledger, cursors = Ledger(str(tmp_path / "ledger.jsonl")), Cursors(str(tmp_path / "cursors.json"))
    say = lambda t, **k: json.dumps({"text": t, "is_from_me": True, "chat_guid": "c", **k})
    batch = envelopes(spark, [("imessage", "1", say("hello Ann x")), ("imessage", "2", say("ssn 123-45-6789")), ("imessage", "3", say("paste", looks_pasted=True)), ("karbon_notes", "4", say("x")), ("imessage", "5", say("key Zx9Qw8Er7Ty6Ui5Op4As3Df2")), ("imessage", "1", say("later copy")), ("imessage", "6", json.dumps({"text": "yo", "is_from_me": False, "handle": "+9", "chat_guid": "c"}))])
    batch = batch.where("source <> 'karbon_notes'")
    got = ingest(vault, cursors, ledger, "imessage", "s", lambda c: (batch, "end"))
    assert (got["inserted"], got["seen"]) == (5, 1) and cursors.get("imessage") == "end"
    assert ingest(vault, cursors, ledger, "imessage", "s", lambda c: (batch, "end"))["inserted"] == 0

    def broken(_):
        raise RuntimeError("disk on fire")

    with pytest.raises(RuntimeError):
        ingest(vault, cursors, ledger, "imessage", "s", broken)
    assert cursors.get("imessage") == "end"
    with pytest.raises(Exception):
        build_corpus(vault, store, ledger, "v1", "s", ["Ann"], None, b"k")
    assert store.versions() == []
    rep = build_corpus(vault, store, ledger, "v1", "s", ["Ann"], "Bo", b"k")
    assert rep == {"written": 3, "redacted": 1, "excluded_confidential": 1, "excluded_pasted": 1, "identity_scrubbed": 1}
    rows = {r["source_id"]: r for r in store.read("v1").collect()}
    assert "Bo" in rows["1"]["text"] and rows["5"]["text"] == "key [REDACTED]" and rows["6"]["author_id"].startswith("P-")
    with pytest.raises(VersionExists):
        build_corpus(vault, store, ledger, "v1", "s", ["Ann"], "Bo", b"k")
    with pytest.raises(UnknownVersion):
        store.read("v9")
    kinds = [r["kind"] for r in ledger.read(spark).collect()]
    assert kinds.count("ingest") == 2 and "ingest_failed" in kinds and "build" in kinds
    gold = str(tmp_path / "golden")
    meta = freeze(store, "v1", gold)
    assert meta["turn_count"] == 3 and load_golden(spark, gold).count() == 3
    with pytest.raises(VersionExists):
        freeze(store, "v1", gold)
    store.write("v2", store.read("v1").where("source_id <> '6'").drop("corpus_version"))
    with pytest.raises(ValueError):
        supersede(spark, store, ledger, "s", "v2", gold, "why")
    assert supersede(spark, store, ledger, "s", "v2", gold, "why", rebaseline=True)["dropped"] == 1
    with pytest.raises(ValueError):
        supersede(spark, store, ledger, "s", "v2", gold, " ")
    path = json.load(open(gold + "/golden.json"))["path"]
    os.chmod(path, 0o644)
    open(path, "a").write("{}\n")
    with pytest.raises(ValueError):
        load_golden(spark, gold)


def test_store_refuses_bad_turns(spark, tmp_path):
    store = CorpusStore(spark, str(tmp_path))
    d = spark.createDataFrame([("m", "1", None), ("m", "2", False)], "source string, source_id string, assisted boolean")
    with pytest.raises(ValueError):
        store.write("v1", d)
    with pytest.raises(ValueError):
        store.write("v1", d.withColumn("assisted", F.lit(False)).withColumn("source_id", F.lit("1")))
    store.write("v1", d.limit(0))
    assert store.versions() == ["v1"] and store.read("v1").count() == 0


def test_ledger_lines(spark, tmp_path):
    led = Ledger(str(tmp_path / "l.jsonl"))
    led.append("x", "s", {"t": "a b c\x85d"})
    led.append("y", "s", {"t": "z"}, ["p"])
    got = led.read(spark).collect()
    assert len(got) == 2 and json.loads(got[0]["payload"])["t"] == "a b c\x85d"


def test_streams(spark, tmp_path):
    src = tmp_path / "t"
    src.mkdir()
    line = lambda t: json.dumps({"type": "user", "message": {"content": t}}) + "\n"
    (src / "a.jsonl").write_text(line("one") + line("two") + '{"type"')
    vault = Vault(spark, str(tmp_path / "v"))
    for want in (2, 3):
        q = stream_transcripts(spark, str(src), vault, str(tmp_path / "cp"), "s", NOW)
        q.processAllAvailable()
        q.stop()
        assert vault.count("claude_code") == want
        (src / "b.jsonl").write_text(line("three"))
    files = str(tmp_path / "in")
    e = envelopes(spark, [("mail", "1", "{}"), ("mail", "2", "{}")])
    e.write.parquet(files)
    for _ in range(2):
        q = stream_envelopes(spark, files, e.schema, vault, str(tmp_path / "cp2"))
        q.awaitTermination()
    assert vault.count("mail") == 2
    s = windowed_counts(spark.readStream.schema(e.schema).parquet(files))
    q = s.writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == 2


def test_inputs(spark, tmp_path):
    f = tmp_path / "f.json"
    f.write_text(json.dumps([{"probe_id": "f1", "question": "q", "expected": "a", "answerable": True}, {"probe_id": "f2", "question": "q", "expected": " ", "answerable": False}]))
    assert inputs.fact_probes(spark, str(f)).count() == 2
    f.write_text(json.dumps([{"probe_id": "f1", "question": "q", "expected": "", "answerable": True}]))
    with pytest.raises(Exception):
        inputs.fact_probes(spark, str(f)).collect()
    f.write_text("{}")
    with pytest.raises(Exception):
        inputs.claims(spark, str(f), "m", 1).collect()
    f.write_text(json.dumps([{"text": "t"}]))
    assert inputs.claims(spark, str(f), "m", 1).first()["source_confidence"] == "unknown"
    assert inputs.parse_probe_lines("# c\n\na | q | x\nU|r||note")[0] == [{"probe_id": "f001", "question": "q", "expected": "x", "answerable": True, "notes": ""}, {"probe_id": "f002", "question": "r", "expected": "", "answerable": False, "notes": "note"}]
    for bad in ("x|q", "A|", "A|q|", "U|q|a"):
        with pytest.raises(ValueError, match="line 1"):
            inputs.parse_probe_lines(bad)
    assert inputs.parse_probe_lines("A|q|???", skip_unfilled=True) == ([], 1)
    assert inputs.worksheet_seeds("## opinions\n- a\n## other\n- b\n## history (x)\n- c") == ["a", "c"]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "x.py").write_text("ok\nMAJOR ann\r\nend")
    (tmp_path / "p" / "data").mkdir()
    (tmp_path / "p" / "data" / "y.py").write_text("ann")
    assert [tuple(r) for r in inputs.leak_lint(spark, str(tmp_path / "p"), ["Ann", " "]).collect()] == [("x.py", 2, "MAJOR ann")]
    y = tmp_path / "s.yaml"
    y.write_text("subject_id: s-1\ndisplay_name: Ann Bo\naliases:\n  - Ann\n  - A. Bo\noccupation: baker\n")
    s = inputs.load_subject(str(y), "s-1")
    assert s.aliases == ("Ann", "A. Bo") and s.pseudonym_name is None
    for sid in ("other", "Bad Id"):
        with pytest.raises(ValueError):
            inputs.load_subject(str(y), sid)
