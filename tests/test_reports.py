"""Reports, baselines, intake and the exit codes of the commands."""

import json
import sqlite3
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from threadloom.__main__ import main
from threadloom.plans import report
from threadloom.plans.corpus import CorpusStore
from threadloom.sources.inputs import Subject


def test_render_says_pending_and_never_zero():
    text = report.render([report.Gate("S2", 1.5, "t", 7, None, "why"), report.Gate("X", 2.0, "u", 3, False), *report.pending()])
    rows = text.splitlines()
    assert rows[1].split()[:4] == ["S2", "1.5000", "7", "pending"] and rows[2].split()[3] == "FAIL" and rows[3].split()[:2] == ["S1", "pending"]
    assert sum(r.startswith("  - ") for r in rows) == 3


def test_gates_of_files_show_no_path(spark, tmp_path):
    g = report.fact_file_gate(spark, f"{tmp_path}/probes/facts.json", str(tmp_path))
    assert g.value is None and g.n == 0 and "probes/facts.json" in g.note and str(tmp_path) not in g.note
    (tmp_path / "probes").mkdir()
    (tmp_path / "probes" / "facts.json").write_text("{")
    assert "cannot be read" in (g := report.fact_file_gate(spark, f"{tmp_path}/probes/facts.json", str(tmp_path))).note and str(tmp_path) not in g.note
    word = lambda i: "".join("abcdefghij"[int(c)] for c in f"{i:03d}")
    rows = [{"probe_id": f"f{i}", "question": f"is {word(i)} it", "expected": "x" if i % 2 else "", "answerable": bool(i % 2), "notes": None} for i in range(200)]
    (tmp_path / "probes" / "facts.json").write_text(json.dumps(rows))
    assert report.fact_file_gate(spark, f"{tmp_path}/probes/facts.json", str(tmp_path)).note.startswith("composition fits (n=200, share=0.50)")
    (tmp_path / "probes" / "refusals.json").write_text(json.dumps([{"probe_id": str(i), "prompt": "p", "should_decline": i < 12} for i in range(60)]))
    assert "out of range" in report.refusal_file_gate(spark, f"{tmp_path}/probes/refusals.json", str(tmp_path)).note


def test_baselines():
    s = Subject("a", "Ann B", occupation="CPA")
    n, i = report.naive_baseline("m"), report.informed_baseline(s, "m")
    assert "Ann B" in i.system_prompt and "CPA" in i.system_prompt and "Ann" not in n.system_prompt
    prints = {report.baseline_fingerprint(b) for b in (n, i, report.naive_baseline("m2"), report.Baseline("X|Y", "Z", 1.0, 1.0, ""), report.Baseline("X", "Y|Z", 1.0, 1.0, ""))}
    assert len(prints) == 5 and all(len(p) == 16 for p in prints)
    for occupation in (None, " "):
        with pytest.raises(report.MissingOccupation):
            report.informed_baseline(Subject("a", "Ann", occupation=occupation), "m")


def test_merge_continues_ids():
    old = [{"probe_id": "fact-007", "question": "How many users does it have?", "answerable": True}, {"probe_id": "odd", "question": "", "answerable": False}]
    new = [{"probe_id": "f001", "question": "How many paying users does it have?", "answerable": True}, {"probe_id": "f002", "question": "When was it?", "answerable": False}, {"probe_id": "f003", "question": "WHEN was it", "answerable": False}, {"probe_id": "f004", "question": "2025?", "answerable": False}, {"probe_id": "f005", "question": "2026?", "answerable": False}]
    kept, added, twice = report.merge_probes(old, new)
    assert (added, twice) == (3, 2) and [p["probe_id"] for p in kept] == ["fact-007", "odd", "fact-008", "fact-009", "fact-010"]
    assert [p["probe_id"] for p in report.merge_probes([], new, renumber=False)[0]] == ["f001", "f002", "f004", "f005"]
    assert "5 probes: 1 answerable, 4 unanswerable (share 0.80)" in report.composition(kept) and "195 more" in report.composition(kept)


@pytest.fixture
def home(spark, tmp_path):
    (tmp_path / "config" / "subjects").mkdir(parents=True)
    (tmp_path / "config" / "subjects" / "ann.yaml").write_text("subject_id: ann\ndisplay_name: Ann Example\naliases:\n  - Annie X\n")
    t0 = datetime(2024, 1, 1)
    line = "For school number {} I prefer the old bridge over the river because my approach was always to walk, and Bridge Street is closer to it than that"
    rows = [("mail", str(i), f"t{i % 25}", t0 + timedelta(hours=i), "ann" if i % 3 else "P-0123456789ab", bool(i % 3), line.format(i), False) for i in range(120)]
    d = spark.createDataFrame(rows, "source string, source_id string, thread_id string, ts timestamp, author_id string, is_subject boolean, text string, assisted boolean")
    store = CorpusStore(spark, f"{tmp_path}/corpus")
    store.write("v1", d)
    store.write("bad", d.withColumn("text", F.concat("text", F.lit(" Annie X"))))
    return tmp_path


def test_commands(home, capsys):
    run = lambda *a: main(["--root", str(home), *a])
    assert run("volume", "ann", "v1") == 0 and "total turns         : 120" in capsys.readouterr().out
    assert run("volume", "ann", "v9") == 2 and run("report", "ann", "v9") == 2
    assert "v9" in capsys.readouterr().err
    assert run("report", "ann", "v1") == 0
    out = capsys.readouterr().out
    assert "total turns    : 120" in out and "S1" in out and "S5" in out and str(home) not in out
    assert run("audit", "ann", "v1") == 0 and capsys.readouterr().out.endswith("PASS\n")
    assert run("audit", "ann", "bad") == 1 and "subject name in text    : 120" in capsys.readouterr().out
    assert run("worksheet", "ann", "v1") == 0 and (home / "probes" / "worksheet.md").read_text().count("\n- ") > 2
    assert run("draft", "ann", "v1", "--entities", '{"bridge": "product"}') == 0 and "# > " in (home / "probes" / "draft.txt").read_text()
    assert run("absences", "ann", "v1", "--entities", '{"bridge": "product"}') == 0
    assert {x["attribute"] for x in json.loads((home / "probes" / "absence-candidates.json").read_text())} == {"user_count", "price", "launch_date", "revenue"}
    (home / "lines.txt").write_text("A | q one? | yes |\nU | q two unlike? | |\nA | open? | ??? |\n")
    assert run("intake", str(home / "lines.txt"), str(home / "f.json")) == 0 and len(json.loads((home / "f.json").read_text())) == 2
    assert run("intake", str(home / "lines.txt"), str(home / "f.json"), "--merge") == 0 and len(json.loads((home / "f.json").read_text())) == 2
    (home / "lines.txt").write_text("Z | q |\n")
    assert run("intake", str(home / "lines.txt"), str(home / "f.json")) == 2
    assert run("leaks") == 0
    (home / "notes.md").write_text("by annie x\n")
    assert run("leaks") == 1
    (home / "config" / "subjects" / "ann.yaml").unlink()
    assert run("leaks") == 2
    c = sqlite3.connect(home / "chat.db")
    c.executescript("create table message(text text, attributedBody blob); insert into message values ('a', null), ('', x'00')")
    c.commit()
    assert run("recovery", str(home / "chat.db")) == 1 and run("recovery", str(home / "none.db")) == 2
