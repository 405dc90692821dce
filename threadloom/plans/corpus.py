"""Corpus build, audit and the stores it writes to."""

from __future__ import annotations

import hashlib
import json
import os
import re
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.functions.scrub import classify, confidential_source, has_secret, identity_map, identity_pattern, marked, matching_view, pseudonymize, redact, scrub_identity
from threadloom.functions.text import source_key, truncate_id
from threadloom.operators.turns import QUARANTINE_WEEKS, normalize, split_corpus, vault_dedupe
from threadloom.session import Stage, collect_bounded, file_system

TURN_COLUMNS = ["subject_id", "source", "source_id", "thread_id", "ts", "author_id", "is_subject", "text", "assisted", "corpus_version"]


def dispositions(envelopes: DataFrame, needles: list[str], replacement: str | None, key: bytes) -> DataFrame:
    """Every non-blank message with what becomes of it: ``confidential``, ``pasted`` or ``kept``, and the scrubbed columns.

    The order is fixed: normalize, classify, paste filter, redact, identity,
    pseudonym; a message excluded by one step is not counted by a later one.
    Fails if a name occurs in a kept text and no replacement is given.
    """
    t = classify(normalize(envelopes), null_error=False)
    t = t.withColumn("disposition", F.when(F.col("tier") == "confidential", "confidential").when(F.col("looks_pasted"), "pasted").otherwise("kept"))
    out = t.where("disposition <> 'kept'").withColumn("redacted", F.col("text"))
    t = redact(t.where("disposition = 'kept'"), null_error=False).unionByName(out)
    p = identity_pattern(needles)
    named = F.lit(False) if p is None else (F.col("disposition") == "kept") & F.col("redacted").rlike(p)
    if replacement is None:
        final = F.when(named, F.raise_error(F.lit("a name occurs but no pseudonym is configured")).cast("string")).otherwise(F.col("redacted"))
    else:
        final = F.when(named, scrub_identity(F.col("redacted"), needles, replacement)).otherwise(F.col("redacted"))
    t = t.withColumn("was_redacted", ~F.col("redacted").eqNullSafe(F.col("text"))).withColumn("was_named", named).withColumn("raw_author", F.col("author_id")).withColumn("final", final)
    return pseudonymize(t, key).withColumn("author_id", F.col("author_out")).withColumn("text", F.col("final")).drop("final", "redacted", "author_out", "tier")


def build_report(d: DataFrame) -> DataFrame:
    kept = F.col("disposition") == "kept"
    return d.agg(
        F.count_if(kept).alias("written"), F.count_if(kept & F.col("was_redacted")).alias("redacted"), F.count_if(F.col("disposition") == "confidential").alias("excluded_confidential"),
        F.count_if(F.col("disposition") == "pasted").alias("excluded_pasted"), F.count_if(kept & F.col("was_named")).alias("identity_scrubbed"),
    )


def audit(turns: DataFrame, needles: list[str], examples: int = 5) -> DataFrame:
    """Findings in a corpus that should have none: ``(finding, n, examples)``, the first few places in order.

    secret, confidential content, author of another person that is no pseudonym, and
    name in the text.  A place is ``source:source_id``; of a raw author it shows the
    first characters and the length, never the whole.
    """
    p = identity_pattern(needles)
    v = matching_view(turns).withColumn("at", F.concat_ws(":", source_key(F.col("source")), "source_id"))
    author = F.coalesce("author_id", F.lit(""))
    shown = F.concat(F.col("at"), F.lit(" author="), truncate_id(author))
    raw = ~F.coalesce("is_subject", F.lit(False)) & ~author.rlike("^P-[0-9a-f]{12}$")
    checks = {
        "confidential": (confidential_source(F.col("source")) | marked(F.col("view")), F.col("at")),
        "raw_author": (raw, shown),
        "name": (F.lit(False) if p is None else F.coalesce(F.col("text").rlike(p), F.lit(False)), F.col("at")),
    }
    flags = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(n).alias("finding"), at.alias("at"))) for n, (c, at) in checks.items()]))
    rows = v.select(F.explode(flags).alias("f")).select("f.*")
    rows = rows.unionByName(v.where(has_secret(F.col("text"))).select(F.lit("secret").alias("finding"), "at"))
    per = rows.groupBy("finding", "at").agg(F.count("*").alias("n"))
    n = per.groupBy("finding").agg(F.sum("n").alias("n"))
    # a rank with a limit: each task keeps the first few of a finding before anything is sent
    first = per.withColumn("r", F.row_number().over(Window.partitionBy("finding").orderBy("at"))).where(F.col("r") <= examples)
    return n.join(first.groupBy("finding").agg(F.array_sort(F.collect_list("at")).alias("examples")), "finding")


class VersionExists(Exception):
    pass


class UnknownVersion(Exception):
    pass


class CorpusStore:
    """Immutable corpus versions on any Hadoop file system: a folder of Parquet per version, published by one rename."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.fs, self.at = file_system(spark, root)

    def _path(self, version: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9._-]{1,64}", version):
            raise ValueError(f"bad version name {version!r}")
        return f"{self.root}/corpus_version={version}"

    def versions(self) -> list[str]:
        names = [x.getPath().getName() for x in self.fs.listStatus(self.at)] if self.fs.exists(self.at) else []
        return sorted(x.partition("=")[2] for x in names if x.startswith("corpus_version="))

    def write(self, version: str, turns: DataFrame) -> int:
        """Write to a staging folder, check keys, publish; nothing remains of a build that fails.  A version without turns is kept too."""
        target = file_system(self.spark, self._path(version))[1]
        if self.fs.exists(target):
            raise VersionExists(version)
        staging = f"{self.root}/.staging-{uuid.uuid4().hex}"
        at = file_system(self.spark, staging)[1]
        try:
            turns.drop("corpus_version").write.parquet(staging)
            d = self.spark.read.schema(turns.drop("corpus_version").schema).parquet(staging)
            n = d.agg(F.count("*"), F.count_if(F.col("assisted").isNull())).first()
            if n[1] or d.groupBy("source", "source_id").count().where("count > 1").head(1):
                raise ValueError("a turn lacks 'assisted' or its key is there twice")
            if not self.fs.rename(at, target):
                raise VersionExists(version)
        finally:
            self.fs.delete(at, True)
        return n[0]

    def read(self, version: str, ordered: bool = False) -> DataFrame:
        """A version, as it is stored or in the order (ts, source_id)."""
        path = self._path(version)
        if not self.fs.exists(file_system(self.spark, path)[1]):
            raise UnknownVersion(version)
        d = self.spark.read.parquet(path).withColumn("corpus_version", F.lit(version))
        return d.orderBy("ts", "source_id") if ordered else d


def split_summary(store: CorpusStore, version: str, now: Column, weeks: int = QUARANTINE_WEEKS) -> DataFrame:
    """Turns of a version in all and per split, one row; an unknown version is an error, never a row of zeros."""
    d = split_corpus(store.read(version), now, weeks)
    return d.agg(F.count("*").alias("total"), *[F.count_if(F.col("split") == s).alias(s) for s in ("train", "heldout", "quarantined")])


class IdentityStore:
    """The key of the pseudonyms and who is behind them: the one place that can undo them, so its folder is closed to others.

    The key is made once, by an exclusive create, and never replaced; the map is a
    side table with each pseudonym once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.fs, self.at = file_system(spark, folder)
        perm = spark.sparkContext._jvm.org.apache.hadoop.fs.permission.FsPermission
        self.fs.mkdirs(self.at)
        self.fs.setPermission(self.at, perm("700"))
        self._private = perm("600")

    def key(self) -> bytes:
        at = file_system(self.spark, f"{self.folder}/identity_key")[1]
        try:
            out = self.fs.create(at, False)
        except Py4JJavaError as e:
            if not self.fs.exists(at):
                raise e
        else:
            out.write(bytearray(os.urandom(32).hex().encode()))
            out.close()
            self.fs.setPermission(at, self._private)
        return bytes.fromhex(self.spark.read.text(f"{self.folder}/identity_key").first()[0])

    def _map(self) -> DataFrame | None:
        at = f"{self.folder}/identity_map"
        return self.spark.read.schema("pseudonym string, raw string").parquet(at) if self.fs.exists(file_system(self.spark, at)[1]) else None

    def add(self, people: DataFrame) -> None:
        """Add ``(pseudonym, raw)`` of those that are not there yet."""
        old = self._map()
        new = people.dropDuplicates(["pseudonym"]) if old is None else people.dropDuplicates(["pseudonym"]).join(old.select("pseudonym"), "pseudonym", "left_anti")
        stage = Stage(new, "identity")
        stage.df.write.mode("append").parquet(f"{self.folder}/identity_map")
        stage.drop()

    def resolve(self, pseudonym: str) -> str | None:
        """Who is behind a pseudonym; null if it is none of ours."""
        old = self._map()
        row = None if old is None else old.where(F.col("pseudonym") == pseudonym).select("raw").head(1)
        return row[0][0] if row else None


class Ledger:
    """Append-only JSON lines; only the newline character ends a line."""

    def __init__(self, path: str):
        self.path = path

    def append(self, kind: str, subject_id: str, payload: dict, parents: list[str] | None = None, now: datetime | None = None) -> str:
        entry = {"entry_id": str(uuid.uuid4()), "ts": (now or datetime.now(timezone.utc)).isoformat(), "kind": kind, "subject_id": subject_id, "payload": payload, "parents": parents or []}
        os.makedirs(os.path.dirname(self.path) or ".", exist_ok=True)
        with open(self.path, "a", encoding="utf-8", newline="\n") as f:
            f.write(json.dumps(entry, ensure_ascii=False) + "\n")
        return entry["entry_id"]

    def read(self, spark: SparkSession) -> DataFrame:
        lines = spark.read.option("lineSep", "\n").text(self.path).where("trim(value) <> ''")
        e = lines.select(F.from_json("value", "entry_id string, ts string, kind string, subject_id string, payload string, parents array<string>").alias("e")).select("e.*")
        return e.withColumn("ts", F.try_to_timestamp("ts"))


class Cursors:
    """Source to position, replaced by one rename."""

    def __init__(self, path: str):
        self.path = path

    def get(self, source: str) -> str | None:
        return json.load(open(self.path, encoding="utf-8")).get(source) if os.path.exists(self.path) else None

    def set(self, source: str, cursor: str) -> None:
        now = json.load(open(self.path, encoding="utf-8")) if os.path.exists(self.path) else {}
        now[source] = cursor
        os.makedirs(os.path.dirname(self.path) or ".", exist_ok=True)
        tmp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        with open(tmp, "w", encoding="utf-8") as f:
            json.dump(now, f, indent=1, sort_keys=True)
        os.replace(tmp, self.path)


class Vault:
    """Raw envelopes, first writer wins on (subject_id, source, source_id); folders by source."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.fs, self.at = file_system(spark, root)

    def read(self, source: str | None = None, ordered: bool = False) -> DataFrame | None:
        """All envelopes or those of a source, as stored or by time; null for a vault that was never written."""
        if not (self.fs.exists(self.at) and any(x.getPath().getName().startswith("source=") for x in self.fs.listStatus(self.at))):
            return None
        d = self.spark.read.option("basePath", self.root).schema("subject_id string, source_id string, ts timestamp, ingested_at timestamp, payload string, source string").parquet(self.root)
        d = d if source is None else d.where(F.col("source") == source)
        return d.orderBy("ts", "source_id") if ordered else d

    def write(self, batch: DataFrame) -> tuple[int, int]:
        """Append the new ones; (inserted, already there).  Writing the same batch again inserts nothing.

        Of the vault only the keys of the batch's sources are read.
        """
        b = batch.select("subject_id", "source", "source_id", "ts", "ingested_at", "payload")
        by = {r["source"]: r["n"] for r in collect_bounded(b.groupBy("source").agg(F.count("*").alias("n")), 10_000)}
        old = self.read()
        new = vault_dedupe(b)
        if old is not None and by:
            old = old.where(F.col("source").isin(*[s for s in by if s is not None]))
            new = new.join(old.select("subject_id", "source", "source_id"), ["subject_id", "source", "source_id"], "left_anti")
        stage = Stage(new, "vault")
        n = stage.df.count()
        if n:
            stage.df.write.mode("append").partitionBy("source").parquet(self.root)
        stage.drop()
        return n, sum(by.values()) - n

    def count(self, source: str) -> int:
        d = self.read(source)
        return 0 if d is None else d.count()


def shown(path: str, root: str) -> str:
    """A path below ``root`` without it; of any other the last step, so no home folder is ever shown."""
    root = root.rstrip("/") + "/"
    return path.removeprefix(root) if path.startswith(root) else path.rstrip("/").rpartition("/")[2]


def without_paths(message: str) -> str:
    """An error's text with every absolute path cut to its last step."""
    return re.sub(r"(?<![\w./:])(?:file:)?/(?:[^\s/'\"]+/)*([^\s/'\"]+)", r"\1", message)


def ingest(vault: Vault, cursors: Cursors, ledger: Ledger, source: str, subject_id: str, fetch: Callable[[str | None], tuple[DataFrame, str]]) -> dict:
    """One path for first and later runs: fetch from the cursor, write, then move the cursor.

    A failure is written to the ledger with its text, leaves the cursor and is
    raised; the vault's keys make a repeated run harmless.
    """
    began = time.time()
    start = cursors.get(source)
    try:
        batch, after = fetch(start)
        inserted, seen = vault.write(batch)
    except Exception as e:
        ledger.append("ingest_failed", subject_id, {"source": source, "cursor": start, "error": without_paths(str(e))[:500]})
        raise
    if after != start:
        cursors.set(source, after)
    entry = ledger.append("ingest", subject_id, {"source": source, "inserted": inserted, "seen": seen, "seconds": round(time.time() - began, 3)})
    return {"source": source, "inserted": inserted, "seen": seen, "entry_id": entry}


def build_corpus(vault: Vault, store: CorpusStore, ledger: Ledger, version: str, subject_id: str, needles: list[str], replacement: str | None, key: bytes) -> dict:
    """All of the vault to one immutable version: all or nothing.

    The identity map is extended before the version is published, so no version is
    ever without it; entries of a build that failed name nobody in any version.
    """
    if version in store.versions():
        raise VersionExists(version)
    env = vault.read()
    if env is None:
        raise ValueError("the vault is empty")
    stage = Stage(dispositions(env, needles, replacement, key), "build")
    report = build_report(stage.df).first().asDict()
    kept = stage.df.where("disposition = 'kept'")
    raw = kept.select(F.col("raw_author").alias("author_id"), "is_subject")
    IdentityStore(store.spark, f"{store.root}/.identity").add(identity_map(raw, key))
    store.write(version, kept.select(*[c for c in TURN_COLUMNS if c != "corpus_version"]))
    ledger.append("build", subject_id, {"version": version} | report)
    stage.drop()
    return report


def freeze(store: CorpusStore, version: str, folder: str) -> dict:
    """A version as one ordered, read-only JSON lines file with its SHA-256; refused if one is frozen."""
    meta_path = os.path.join(folder, "golden.json")
    if os.path.exists(meta_path):
        raise VersionExists("a golden corpus is frozen already")
    return _dump(store, version, folder)


def _dump(store: CorpusStore, version: str, folder: str) -> dict:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"golden-{version}-{uuid.uuid4().hex[:8]}.jsonl")
    h, n = hashlib.sha256(), 0
    d = store.read(version).orderBy("ts", "source", "source_id").select(F.to_json(F.struct(*TURN_COLUMNS)).alias("j"))
    with open(path, "wb") as f:
        for r in d.toLocalIterator():
            line = (r["j"] + "\n").encode()
            h.update(line)
            f.write(line)
            n += 1
    os.chmod(path, 0o444)
    meta = {"version": version, "path": path, "sha256": h.hexdigest(), "turn_count": n}
    with open(os.path.join(folder, "golden.json.tmp"), "w", encoding="utf-8") as f:
        json.dump(meta, f)
    os.replace(os.path.join(folder, "golden.json.tmp"), os.path.join(folder, "golden.json"))
    return meta


def load_golden(spark: SparkSession, folder: str) -> DataFrame:
    """The frozen corpus after its hash is checked again."""
    meta = json.load(open(os.path.join(folder, "golden.json"), encoding="utf-8"))
    h = hashlib.sha256()
    with open(meta["path"], "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            h.update(block)
    if h.hexdigest() != meta["sha256"]:
        raise ValueError("the golden corpus was changed")
    return spark.read.schema("subject_id string, source string, source_id string, thread_id string, ts timestamp, author_id string, is_subject boolean, text string, assisted boolean, corpus_version string").option("lineSep", "\n").json(meta["path"])


def supersede(spark: SparkSession, store: CorpusStore, ledger: Ledger, subject_id: str, version: str, folder: str, reason: str, rebaseline: bool = False) -> dict:
    """Freeze a later version instead.  Refused with assisted turns, and unless ``rebaseline`` with dropped or rewritten ones; a reason is needed."""
    from threadloom.operators.turns import golden_diff

    if not reason or not reason.strip():
        raise ValueError("a reason is needed")
    new = store.read(version)
    if new.where("assisted").head(1):
        raise ValueError("assisted turns cannot be golden")
    d = golden_diff(load_golden(spark, folder), new).first().asDict()
    if not rebaseline and (d["dropped"] or d["rewritten"]):
        raise ValueError(f"{d['dropped']} turns dropped, {d['rewritten']} rewritten")
    old = os.path.join(folder, "golden.json")
    os.replace(old, os.path.join(folder, f"golden-{uuid.uuid4().hex[:8]}.old.json"))
    meta = _dump(store, version, folder)
    ledger.append("rebaseline" if rebaseline else "supersede", subject_id, {"version": version, "reason": reason} | d)
    return meta | d
