"""Probe files, claims, subject settings, worksheets and the leak search."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.text import is_blank, short_hash, trim_u

FACT = "probe_id string, question string, expected string, answerable boolean, notes string"
REFUSAL = "probe_id string, prompt string, should_decline boolean, notes string"
PLACEHOLDER = "???"


def _list(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    text = spark.read.text(path, wholetext=True)
    v = F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", f"array<struct<{','.join(':'.join(c.split()) for c in schema.split(', '))}>>", {"mode": "FAILFAST"}))
    return text.select(F.explode(F.coalesce(v, F.raise_error(F.lit("not a JSON list")).cast(f"array<struct<{','.join(':'.join(c.split()) for c in schema.split(', '))}>>"))).alias("p")).select("p.*")


def fact_probes(spark: SparkSession, path: str) -> DataFrame:
    """Fact probes; an answerable one without expected answer, or another with one, is an error."""
    p = _list(spark, path, FACT)
    blank = is_blank(F.col("expected"))
    bad = F.col("answerable").isNull() | (F.col("answerable") & blank) | (~F.col("answerable") & ~blank)
    return p.withColumn("probe_id", F.when(bad, F.raise_error(F.concat(F.lit("bad probe "), F.coalesce("probe_id", F.lit("?")))).cast("string")).otherwise(F.col("probe_id"))).withColumn("notes", F.coalesce("notes", F.lit("")))


def refusal_probes(spark: SparkSession, path: str) -> DataFrame:
    return _list(spark, path, REFUSAL).withColumn("notes", F.coalesce("notes", F.lit("")))


def claims(spark: SparkSession, path: str, model: str, run: int) -> DataFrame:
    """Claims of one report with an id from model, run and text."""
    c = _list(spark, path, "text string, evidence_quote string, source_confidence string, disconfirming_case string")
    return c.select(
        short_hash(16, F.lit(model), F.lit(str(run)), F.col("text")).alias("claim_id"), "text", F.lit(model).alias("source_model"), F.lit(run).alias("run"), F.coalesce("evidence_quote", F.lit("")).alias("evidence_quote"),
        F.coalesce("source_confidence", F.lit("unknown")).alias("source_confidence"), F.coalesce("disconfirming_case", F.lit("")).alias("disconfirming_case"),
    )


def parse_probe_lines(text: str, skip_unfilled: bool = False) -> tuple[list[dict], int]:
    """``kind | question | expected | notes`` lines to probes, all or nothing; (probes, unfilled rows skipped).  Errors name the line."""
    out, skipped = [], 0
    for no, line in enumerate(text.split("\n"), 1):
        if not line.strip() or line.strip().startswith("#"):
            continue
        kind, question, expected, notes, *_ = [*(x.strip() for x in line.split("|")), "", "", ""]
        kind = kind.upper()
        if kind not in ("A", "U"):
            raise ValueError(f"line {no}: kind must be A or U")
        if not question:
            raise ValueError(f"line {no}: no question")
        if kind == "A" and expected == PLACEHOLDER and skip_unfilled:
            skipped += 1
            continue
        if (kind == "A") != bool(expected):
            raise ValueError(f"line {no}: {'an answer is missing' if kind == 'A' else 'there must be no answer'}")
        out.append({"probe_id": f"f{len(out) + 1:03d}", "question": question, "expected": expected, "answerable": kind == "A", "notes": notes})
    return out, skipped


def worksheet_seeds(text: str, sections: tuple[str, ...] = ("preferences", "opinions", "decisions", "history")) -> list[str]:
    """Bullets under the named ``## `` headings."""
    out, on = [], False
    for line in text.split("\n"):
        if line.startswith("## "):
            on = any(line[3:].strip().lower().startswith(s) for s in sections)
        elif on and line.startswith("- "):
            out.append(line[2:].strip())
    return out


# The files a leak search reads and the folders it passes by.
TEXT_SUFFIXES = (".py", ".md", ".yaml", ".yml", ".toml", ".json", ".txt", ".sh")
SKIP_DIRS = (".git", ".venv", "__pycache__", ".pytest_cache", "node_modules", ".superpowers", ".token-optimizer")
#: What ends a line.
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def leak_lint(spark: SparkSession, root: str, needles: list[str], allow: tuple[str, ...] = ("config", "data")) -> DataFrame:
    """``(path, line_no, line)`` of every line below a folder that holds a needle in any case, outside the allowed folders."""
    low = [n.lower() for n in needles if n.strip()]
    if not low:
        return spark.createDataFrame([], "path string, line_no int, line string")
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "content")
    base = os.path.abspath(root).rstrip("/") + "/"
    rel = F.expr(f"substring(path, instr(path, '{base}') + {len(base)})")
    f = f.withColumn("rel", rel).where(F.col("rel").rlike("(" + "|".join(re.escape(s) for s in TEXT_SUFFIXES) + ")$"))
    parts = F.split("rel", "/")
    f = f.where(~F.arrays_overlap(parts, F.array(*map(F.lit, SKIP_DIRS))) & ~parts[0].isin(*allow))
    lines = f.select(F.col("rel").alias("path"), F.posexplode(F.split(F.decode("content", "UTF-8"), LINE_END)).alias("i", "line"))
    hit = F.lit(False)
    for n in low:
        hit = hit | F.lower("line").contains(n)
    return lines.where(hit).select("path", (F.col("i") + 1).alias("line_no"), trim_u(F.col("line")).alias("line"))


@dataclass(frozen=True)
class Subject:
    subject_id: str
    display_name: str
    aliases: tuple[str, ...] = field(default_factory=tuple)
    occupation: str | None = None
    pseudonym_name: str | None = None


def load_subject(path: str, subject_id: str) -> Subject:
    """Settings of a subject from YAML (``key: value`` and lists); the file must be there and name the same subject."""
    if not re.fullmatch(r"[a-z0-9][a-z0-9_-]{0,63}", subject_id):
        raise ValueError(f"bad subject id {subject_id!r}")
    text = open(path, encoding="utf-8").read()
    try:
        import yaml

        d = yaml.safe_load(text) or {}
    except ImportError:
        d, key = {}, None
        for line in text.split("\n"):
            if m := re.match(r"^([a-z_]+):\s*(.*?)\s*$", line):
                key = m[1]
                v = m[2].strip("\"'")
                d[key] = [x.strip().strip("\"'") for x in v[1:-1].split(",") if x.strip()] if v.startswith("[") else v or []
            elif (m := re.match(r"^\s*-\s+(.*?)\s*$", line)) and key:
                d[key] = [*d[key], m[1].strip("\"'")]
    if d.get("subject_id") != subject_id:
        raise ValueError(f"{path} is of another subject")
    return Subject(subject_id, d["display_name"], tuple(d.get("aliases") or ()), d.get("occupation") or None, d.get("pseudonym_name") or None)
