"""``python -m threadloom COMMAND``: reports and probe files of one subject's data folder.

The folder (``--root``) holds ``corpus`` (versions), ``probes`` and
``config/subjects/<subject>.yaml``.  Exit codes: 0 well, 1 a check failed, 2 what
was asked for is not there or cannot be read.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from threadloom.operators import evaluation as ev
from threadloom.operators.turns import split_corpus
from threadloom.plans import report
from threadloom.plans.corpus import CorpusStore, UnknownVersion, split_summary, without_paths
from threadloom.session import get_session
from threadloom.sources import connectors, inputs


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="threadloom", description=__doc__)
    ap.add_argument("--root", default=".")
    sub = ap.add_subparsers(dest="command", required=True)
    for name in ("volume", "report", "audit", "worksheet", "absences", "draft"):
        p = sub.add_parser(name)
        p.add_argument("subject")
        p.add_argument("version")
        if name in ("absences", "draft"):
            p.add_argument("--entities", required=True, help="JSON object of entity to kind")
    sub.add_parser("recovery").add_argument("database")
    sub.add_parser("leaks")
    p = sub.add_parser("intake")
    p.add_argument("lines")
    p.add_argument("probes")
    p.add_argument("--merge", action="store_true")
    return ap.parse_args(argv)


def _needles(root: str, subject: str | None = None) -> list[str]:
    at = os.path.join(root, "config", "subjects")
    names = sorted(x for x in os.listdir(at) if x.endswith(".yaml") and x != "example.yaml") if os.path.isdir(at) else []
    out: list[str] = []
    for n in names:
        if subject in (None, n.removesuffix(".yaml")):
            s = inputs.load_subject(os.path.join(at, n), n.removesuffix(".yaml"))
            out += [s.display_name, *s.aliases]
    return [x for x in out if x.strip()]


def _intake(a: argparse.Namespace) -> int:
    with open(a.lines, encoding="utf-8") as f:
        new, unfilled = inputs.parse_probe_lines(f.read(), skip_unfilled=True)
    old = []
    if a.merge and os.path.exists(a.probes):
        with open(a.probes, encoding="utf-8") as f:
            old = json.load(f)
    kept, added, twice = report.merge_probes(old, new, renumber=a.merge)
    report.write_text(a.probes, json.dumps(kept, indent=2, ensure_ascii=False) + "\n")
    print(f"{'merged into' if a.merge else 'wrote'} {a.probes}: {added} added, {twice} duplicates skipped, {unfilled} unfilled skipped")
    print(report.composition(kept))
    return 0


def _run(a: argparse.Namespace) -> int:
    if a.command == "intake":
        return _intake(a)
    spark = get_session()
    spark.sparkContext.setLogLevel("ERROR")
    if a.command == "recovery":
        if not os.path.exists(a.database):
            raise FileNotFoundError(a.database)
        r = connectors.recovery(spark, a.database).first()
        print(f"messages {r['n_rows']}, without text {r['n_blank']}, bodies {r['n_bodies']}, decoded {r['n_decoded']}, rate {r['rate']:.1%}")
        print("GATE: PASS" if r["passed"] else "GATE: FAIL (<95%)")
        return 0 if r["passed"] else 1
    if a.command == "leaks":
        needles = _needles(a.root)
        if not needles:
            print("no subject to look for", file=sys.stderr)
            return 2
        hits = 0
        for r in inputs.leak_lint(spark, a.root, needles).orderBy("path", "line_no").toLocalIterator():
            hits += 1
            print(f"{r['path']}:{r['line_no']}: a subject is named: {r['line']}")
        return 1 if hits else 0
    store = CorpusStore(spark, os.path.join(os.path.abspath(a.root), "corpus"))
    now = F.lit(datetime.now(timezone.utc))
    probes = os.path.join(os.path.abspath(a.root), "probes")
    if a.command == "report":
        s = split_summary(store, a.version, now).first()
        print(f"corpus version : {a.version}\ntotal turns    : {s['total']:,}\n  train        : {s['train']:,}\n  held out     : {s['heldout']:,}\n  quarantined  : {s['quarantined']:,}\n")
        root = os.path.abspath(a.root)
        print(report.render([report.style_gate(store, a.version, now), report.fact_file_gate(spark, f"{probes}/facts.json", root), report.refusal_file_gate(spark, f"{probes}/refusals.json", root), *report.pending()]))
        return 0
    turns = store.read(a.version)
    if a.command == "volume":
        print("\n".join(report.volume_lines(turns, a.version)))
        return 0
    if a.command == "audit":
        lines, ok = report.audit_lines(turns, _needles(a.root, a.subject), a.version)
        print("\n".join(lines))
        return 0 if ok else 1
    parts = split_corpus(turns, now)
    train, held = parts.where("split = 'train' and is_subject"), parts.where("split = 'heldout'")
    if a.command == "worksheet":
        n = split_summary(store, a.version, now).first()
        path = f"{probes}/worksheet.md"
        report.write_text(path, report.worksheet(f"{a.subject} / {a.version}", ev.worksheet_lines(train, held), ev.topics(train), train.count(), n["heldout"], n["quarantined"]))
        print(f"wrote {path}")
        return 0
    entities = json.loads(a.entities)
    if a.command == "absences":
        c = ev.absence_candidates(train, entities)
        print(f"{report.absence_file(c, f'{probes}/absence-candidates.json')} candidates")
        for r in c.where("skipped is not null").orderBy("entity", "attribute").toLocalIterator():
            print(f"  skipped: {r['entity']} {r['attribute']}: {r['skipped']}")
        return 0
    with open(f"{probes}/worksheet.md", encoding="utf-8") as f:
        seeds = inputs.worksheet_seeds(f.read())
    text, n_rows = report.draft(seeds, ev.answerable_rows(train, entities))
    report.write_text(f"{probes}/draft.txt", text)
    print(f"wrote {probes}/draft.txt: {n_rows} rows, {len(seeds)} lines")
    return 0


def main(argv: list[str] | None = None) -> int:
    a = _arguments(argv)
    try:
        return _run(a)
    except UnknownVersion as e:
        print(f"error: no corpus version {e}", file=sys.stderr)
    except (OSError, ValueError, PySparkException) as e:
        print(f"error: {without_paths(str(e))[:500]}", file=sys.stderr)
    return 2


if __name__ == "__main__":
    sys.exit(main())
