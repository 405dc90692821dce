"""Queries of sources and stores: the test tables rendered as each source's files, read back by its connector.

Every task writes files of its own into one folder that all executors see; what
comes out is compared with SQL over the table the files were made from.
"""

from __future__ import annotations

import io
import json
import mailbox
import os
import sqlite3
import subprocess
import uuid
import zipfile
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from email.message import EmailMessage
from email.utils import format_datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import text
from threadloom.operators import turns as ops
from threadloom.operators.evaluation import ATTRIBUTES
from threadloom.plans import corpus, report
from threadloom.queries import _BUILD, _S, _TRIMMED, CLAIMS, ENTITIES, KEY, QUERIES, SQL, SRC, VERSION, WITHHELD, needles, query, scrub_sql, split_now
from threadloom.session import Stage, collect_bounded, file_system, shared_dir
from threadloom.sources import connectors as C
from threadloom.sources import inputs

NOW = datetime(2026, 3, 1, tzinfo=timezone.utc)


def folder(spark: SparkSession, tag: str) -> str:
    """A new folder in the shared one, on a mounted file system; it goes when the driver ends."""
    path = f"{shared_dir(spark)}/threadloom/{tag}-{uuid.uuid4().hex}"
    fs, at = file_system(spark, path)
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    return path.removeprefix("file://").removeprefix("file:")


def write_files(df: DataFrame, at: str, suffix: str, save: Callable[[str, Iterator[dict]], None], parts: int = 4) -> None:
    """``save(path, rows)`` once per task, over the rows it has."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for pdf in batches for r in pdf.astype(object).where(pdf.notna(), None).to_dict("records"))
        save(f"{at}/part-{uuid.uuid4().hex}{suffix}", rows)
        yield pd.DataFrame({"done": [1]})

    df.repartition(parts).mapInPandas(run, "done int").agg(F.count("*")).collect()


def _json_lines(path: str, rows: Iterator[dict]) -> None:
    with open(path, "w", encoding="utf-8", newline="\n") as f:
        for r in rows:
            f.write(r["line"] + "\n")


def _one_json(wrap: str):
    def save(path: str, rows: Iterator[dict]) -> None:
        with open(path, "w", encoding="utf-8") as f:
            f.write(wrap.replace("%", ",".join(r["doc"] for r in rows)))

    return save


def _zipped(path: str, rows: Iterator[dict]) -> None:
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("export/conversations.json", "[" + ",".join(r["doc"] for r in rows) + "]")


def _payload(e: DataFrame, *names: str) -> DataFrame:
    return e.select("*", *[F.col("payload")[n].alias(n) for n in names])


def _fields(t, source: str, *names: str) -> DataFrame:
    """First arrivals of a source with the named payload fields; payloads that are no objects are left out."""
    e = ops.vault_dedupe(t("envelopes").where(text.source_key(F.col("source")) == source))
    e = e.withColumn("payload", F.from_json("payload", "map<string,string>", {"allowSingleQuotes": "false"})).where("payload is not null")
    return _payload(e, *names).drop("payload")


_FIRST = "(SELECT *, CASE WHEN json_valid(payload) AND payload LIKE '{{%' THEN payload END AS o FROM envelopes WHERE lower(trim(source)) = '{}' QUALIFY row_number() OVER (PARTITION BY subject_id, source, source_id ORDER BY ingested_at, ts, payload) = 1)"
_TRIM = rf"regexp_replace(regexp_replace({{}}, '^{_S}+', ''), '{_S}+$', '')".replace("{85}", "{{85}}").replace("p{Z}", "p{{Z}}")


def _out(df: DataFrame, **kinds: str) -> DataFrame:
    """Named payload fields of envelopes, cast."""
    p = F.from_json("payload", "map<string,string>")
    return df.select("ts", "source_id", *[p[n].cast(k).alias(n) for n, k in kinds.items()])


def _us(c: str = "ts") -> Column:
    return F.unix_micros(c).alias("ts_us")


# the chat database


def _chat_db(path: str, rows: Iterator[dict]) -> None:
    c = sqlite3.connect(path)
    c.executescript("create table message(guid text, text text, attributedBody blob, is_from_me int, date int, handle_id int); create table handle(id text); create table chat(guid text); create table chat_message_join(chat_id int, message_id int); insert into chat values ('zz-other')")
    ids: dict[tuple, int] = {}

    def ident(table: str, column: str, value):
        if value is None:
            return None
        if (table, value) not in ids:
            ids[table, value] = c.execute(f"insert into {table}({column}) values (?)", (value,)).lastrowid
        return ids[table, value]

    for r in rows:
        body, said = None, r["text"]
        if r["as_body"] and said is not None:
            b = said.encode()
            n = bytes([len(b)]) if len(b) < 0x80 else b"\x81" + len(b).to_bytes(2, "little") if len(b) < 65_536 else b"\x82" + len(b).to_bytes(4, "little")
            body, said = b"\x04\x0bstreamtyped\x84NSString\x01\x94\x84\x01+" + n + b + b"\x86\x84", None
        m = c.execute("insert into message values (?,?,?,?,?,?)", (r["source_id"], said, body, int(r["mine"]), r["ns"], ident("handle", "id", r["handle"]))).lastrowid
        chat = ident("chat", "guid", r["chat_guid"])
        if chat is not None:
            c.executemany("insert into chat_message_join values (?, ?)", [(1, m), (chat, m)])
    c.commit()
    c.close()


def _chat_file(t) -> str:
    """A message by the last digit of its id has a binary body instead of a text; each with a chat is in a second one too."""
    e = _fields(t, "imessage", "text", "is_from_me", "handle", "chat_guid")
    spark = e.sparkSession
    at = folder(spark, "chat")
    odd = F.ascii(F.substring("source_id", -1, 1)) % 2 == 1
    e = e.select("source_id", "text", odd.alias("as_body"), (F.lower("is_from_me") == "true").alias("mine"), "handle", "chat_guid", ((F.unix_micros("ts") - F.lit(978307200000000)) * 1000).alias("ns"))
    write_files(e.withColumn("mine", F.coalesce("mine", F.lit(False))), at, ".db", _chat_db, 1)
    return os.path.join(at, next(f for f in os.listdir(at) if f.endswith(".db")))


_CHAT = _FIRST.format("imessage")


@query(f"SELECT o ->> '$.text' AS text, coalesce((o ->> '$.is_from_me') = 'true', false) AS is_from_me, coalesce(o ->> '$.handle', 'unknown') AS handle, coalesce(o ->> '$.chat_guid', 'unknown') AS chat_guid, epoch_us(ts) AS ts_us FROM {_CHAT} WHERE o IS NOT NULL AND {_TRIM.format("coalesce(o ->> '$.text', '')")} <> ''")
def chat_database(t):
    """Messages out of a chat database: joins of four tables, bodies decoded, the smallest of several chats."""
    e = C.chat_database(t.spark, _chat_file(t), "s", NOW)
    return _out(e, text="string", is_from_me="boolean", handle="string", chat_guid="string").select("text", "is_from_me", "handle", "chat_guid", _us())


_BODY = "ascii(right(source_id, 1)) % 2 = 1 AND (o ->> '$.text') IS NOT NULL"
_NO_TEXT = _TRIM.format("coalesce(o ->> '$.text', '')") + " = ''"


@query(f"SELECT count(*) AS n_rows, count(*) FILTER ({_BODY} OR {_NO_TEXT}) AS n_blank, count(*) FILTER ({_BODY}) AS n_bodies, count(*) FILTER ({_BODY}) AS n_decoded, 1.0 AS rate, true AS passed FROM {_CHAT} WHERE o IS NOT NULL")
def recovery_probe(t):
    return C.recovery(t.spark, _chat_file(t))


# growing transcripts


@query(
    f"SELECT turn_id % 2 AS run, {_TRIMMED} AS text, length({_TRIM.format('text')})::BIGINT AS raw_chars, length({_TRIMMED})::BIGINT AS prose_chars, length({_TRIMMED}) > 8000 OR length({_TRIM.format('text')}) - length({_TRIMMED}) > length({_TRIM.format('text')}) / 2.0 AS looks_pasted "
    f"FROM turns WHERE {SRC} = 'claude_code' AND {_TRIM.format("coalesce(text, '')")} <> ''"
)
def transcripts_resumed(t):
    """Session transcripts read in two runs: the second begins where the cursor of the first ended."""
    d = t("turns").where((text.source_key(F.col("source")) == "claude_code") & F.col("text").isNotNull())
    kind = F.col("turn_id") % 3
    part = F.to_json(F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text")), F.struct(F.lit("tool_use").alias("type"), F.lit("x").alias("text"))))
    said = F.to_json(F.struct(F.when(kind == 2, F.concat("text", F.lit("<system-reminder>nothing</system-reminder>"))).otherwise(F.col("text")).alias("t")))
    content = F.when(kind == 1, part).otherwise(F.expr("substring(said, 6, length(said) - 6)"))
    d = d.withColumn("said", said).withColumn("line", F.concat(F.lit('{"type": "user", "message": {"role": "user", "content": '), content, F.lit("}}")))
    reply = F.when(kind == 0, F.lit('{"type": "assistant", "message": {"content": "no"}}')).otherwise("{damaged")
    d = d.withColumn("line", F.concat_ws("\n", reply, "line"))
    at, cursor, runs = folder(t.spark, "transcripts"), None, []
    for k in (0, 1):
        write_files(d.where(F.col("turn_id") % 2 == k).select("line"), at, ".jsonl", _json_lines)
        e, cursor = C.transcripts(t.spark, at, "s", NOW, cursor)
        runs.append(Stage(_out(e, text="string", raw_chars="bigint", prose_chars="bigint", looks_pasted="boolean").drop("ts", "source_id").withColumn("run", F.lit(k).cast("bigint")), "run").df)
    return runs[0].unionByName(runs[1])


# exports


def _iso(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


_AI = _FIRST.format("claude_ai")


@query(f"SELECT source_id, o ->> '$.conversation_uuid' AS conversation_uuid, {_TRIM.format("o ->> '$.text'")} AS text, o ->> '$.parent_message_uuid' AS parent_message_uuid, length(source_id) % 3 AS attachment_count, (length(source_id) % 3) * 4 AS attachment_chars, epoch_us(ts) AS ts_us FROM {_AI} WHERE o ->> '$.sender' = 'human' AND {_TRIM.format("coalesce(o ->> '$.text', '')")} <> ''")
def chat_export_zipped(t):
    """Zipped conversation lists; a text may stand in content blocks instead, attachments are counted only."""
    e = _fields(t, "claude_ai", "text", "conversation_uuid", "sender", "parent_message_uuid")
    block = F.length("source_id") % 2 == 0
    msg = F.struct(
        F.col("source_id").alias("uuid"), "sender", F.when(block, "").otherwise(F.col("text")).alias("text"), F.when(block, F.array(F.struct(F.lit("text").alias("type"), "text"))).alias("content"), _iso("ts").alias("created_at"), "parent_message_uuid",
        F.array_repeat(F.struct(F.lit("four").alias("extracted_content")), (F.length("source_id") % 3).cast("int")).alias("attachments"),
    )
    c = e.groupBy(F.col("conversation_uuid").alias("uuid")).agg(F.collect_list(msg).alias("chat_messages"))
    at = folder(t.spark, "zip")
    write_files(c.select(F.to_json(F.struct("uuid", "chat_messages")).alias("doc")), at, ".zip", _zipped)
    got, _ = C.zip_export(t.spark, at, "s", NOW)
    return _out(got, conversation_uuid="string", text="string", parent_message_uuid="string", attachment_count="bigint", attachment_chars="bigint").select("*", _us()).drop("ts")


@query(f"SELECT turn_id::VARCHAR AS source_id, thread_id AS context_uuid, {_TRIM.format('text')} AS text, CASE WHEN turn_id % 2 = 0 THEN 'COMPLETED' ELSE 'FAILED' END AS query_status, epoch_us(ts) AS ts_us FROM turns WHERE {SRC} = 'perplexity' AND {_TRIM.format("coalesce(text, '')")} <> ''")
def query_export(t):
    d = t("turns").where(text.source_key(F.col("source")) == "perplexity")
    entry = F.struct(F.col("turn_id").cast("string").alias("entry_uuid"), F.col("text").alias("query"), _iso("ts").alias("created_at"), F.when(F.col("turn_id") % 2 == 0, "COMPLETED").otherwise("FAILED").alias("query_status"))
    c = d.groupBy(F.col("thread_id").alias("context_uuid")).agg(F.collect_list(entry).alias("entries"))
    at = folder(t.spark, "queries")
    write_files(c.select(F.to_json(F.struct("context_uuid", "entries")).alias("doc")), at, ".json", _one_json('{"conversations": [%]}'))
    got, _ = C.query_export(t.spark, at, "s", NOW)
    return _out(got, context_uuid="string", text="string", query_status="string").select("*", _us()).drop("ts")


@query(f"""
WITH RECURSIVE d AS {_FIRST.format('chatgpt')},
n AS (SELECT o ->> '$.conversation_id' AS c, source_id AS id, o ->> '$.parent' AS parent, o ->> '$.role' AS role, o ->> '$.text' AS text, ts FROM d WHERE o ->> '$.conversation_id' IS NOT NULL),
w AS (SELECT c, id, parent, [id] AS path FROM n QUALIFY row_number() OVER (PARTITION BY c ORDER BY ts DESC, id DESC) = 1
  UNION ALL SELECT n.c, n.id, n.parent, [n.id] || w.path FROM w JOIN n ON n.c = w.c AND n.id = w.parent WHERE NOT list_contains(w.path, n.id))
SELECT n.id AS source_id, n.c AS conversation_id, n.text, length(n.id) % 2 AS image_count, epoch_us(n.ts) AS ts_us FROM w JOIN n USING (c, id) WHERE n.role = 'user' AND {_TRIM.format("coalesce(n.text, '')")} <> ''
""")
def graph_export(t):
    """Conversation graphs; only what lies on the branch of the current node comes out."""
    e = _fields(t, "chatgpt", "text", "conversation_id", "role", "parent").where("conversation_id is not null")
    image = F.to_json(F.array(F.struct(F.lit("image_asset_pointer").alias("content_type"))))
    # parts are a list of strings and objects: put together as text
    said = F.to_json(F.array(F.coalesce("text", F.lit(""))))
    parts = F.when(F.length("source_id") % 2 == 1, F.concat(F.expr("substring(said, 1, length(said) - 1)"), F.lit(","), F.expr("substring(image, 2)"))).otherwise(F.col("said"))
    e = e.withColumn("said", said).withColumn("image", image).withColumn("parts", parts)
    head = F.to_json(F.struct(F.col("source_id").alias("id"), F.struct("role").alias("author"), (F.unix_micros("ts") / 1e6).alias("create_time")))
    node = F.concat(
        F.expr("concat('\"', source_id, '\": {\"parent\": ')"), F.coalesce(F.concat(F.lit('"'), "parent", F.lit('"')), F.lit("null")),
        F.lit(', "message": '), F.expr("substring(head, 1, length(head) - 1)"), F.lit(', "content": {"content_type": "multimodal_text", "parts": '), "parts", F.lit("}}}"),
    )
    e = e.withColumn("head", head).withColumn("node", node)
    c = e.groupBy("conversation_id").agg(F.concat_ws(",", F.collect_list("node")).alias("nodes"), F.max(F.struct("ts", "source_id"))["source_id"].alias("now"))
    doc = F.concat(F.lit('{"conversation_id": "'), "conversation_id", F.lit('", "current_node": "'), "now", F.lit('", "mapping": {'), "nodes", F.lit("}}"))
    at = folder(t.spark, "graphs")
    write_files(c.select(doc.alias("doc")), at, ".json", _one_json("[%]"))
    got, _ = C.graph_export(t.spark, at, "s", NOW)
    return _out(got, conversation_id="string", text="string", image_count="bigint").select("*", _us()).drop("ts")


# mail and commits


def _mbox(path: str, rows: Iterator[dict]) -> None:
    box = mailbox.mbox(path)
    for r in rows:
        m = EmailMessage()
        m["From"] = "Other <other@example.org>" if r["turn_id"] % 4 == 0 else "The Sender <Me@Example.org>"
        m["To"], m["Subject"], m["Message-ID"] = "a@example.org", f"s{r['turn_id']}", f"<{r['turn_id']}@example.org>"
        m["Date"] = format_datetime(r["ts"].to_pydatetime().replace(tzinfo=timezone.utc)) if r["turn_id"] % 7 else "some day"
        m.set_content(r["text"])
        box.add(m)
    box.close()


_MAIL_CTE, _MAIL_BODY = SQL["strip_quoted"].strip().split("\nSELECT turn_id, ", 1)
_READ_AS = "CASE WHEN turn_id % 7 = 0 THEN epoch_us(TIMESTAMPTZ '2026-03-01 00:00:00+00') ELSE epoch_us(ts) // 1000000 * 1000000 END AS ts_us"


@query(
    _MAIL_CTE.replace("SELECT turn_id, ", "SELECT turn_id, ts, ").replace("regexp_replace(text,", r"regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'),")  # a mail's lines end alike
    + f" SELECT * FROM (SELECT '<' || turn_id || '@example.org>' AS source_id, 's' || turn_id AS subject, {_READ_AS}, {_MAIL_BODY.replace('AS body', 'AS text')} WHERE turn_id % 4 <> 0) WHERE text <> ''"
)
def mailboxes(t):
    """Mail of one sender out of mailboxes, quotations stripped; a date that cannot be read is ``now``."""
    d = t("turns").where((text.source_key(F.col("source")) == "mail") & F.col("text").isNotNull()).select("turn_id", "ts", "text")
    at = folder(t.spark, "mail")
    write_files(d, at, ".mbox", _mbox)
    got, _ = C.mailboxes(t.spark, at, ["me@example.org"], "s", NOW)
    return _out(got, text="string", subject="string").select("source_id", "text", "subject", _us())


def _repository(path: str, rows: Iterator[dict]) -> None:
    os.makedirs(path)
    subprocess.run(["git", "init", "-q", path], check=True)
    out = io.BytesIO()
    for r in sorted(rows, key=lambda r: r["turn_id"]):
        msg = r["text"].encode()
        who = b"Dev <Dev@Example.org>" if r["turn_id"] % 3 else b"Else <else@example.org>"
        out.write(b"commit refs/heads/main\nauthor %s %d +0000\ncommitter %s %d +0000\ndata %d\n%s\n" % (who, r["sec"], who, r["sec"], len(msg), msg))
    subprocess.run(["git", "-C", path, "fast-import", "--quiet"], input=out.getvalue(), check=True)
    subprocess.run(["git", "-C", path, "symbolic-ref", "HEAD", "refs/heads/main"], check=True)


@query(f"SELECT {_TRIM.format('text')} AS text, greatest(epoch_us(ts) // 1000000, 0) * 1000000 AS ts_us FROM turns WHERE {SRC} = 'git_repos' AND turn_id % 3 <> 0 AND {_TRIM.format("coalesce(text, '')")} <> ''")
def git_commits(t):
    d = t("turns").where((text.source_key(F.col("source")) == "git_repos") & ~text.is_blank(F.col("text"))).select("turn_id", "text", F.greatest(F.unix_seconds("ts"), F.lit(0)).alias("sec"))
    at = folder(t.spark, "git")
    write_files(d, at, "", _repository, 2)
    got, _ = C.git_log(t.spark, ",".join(sorted(os.path.join(at, x) for x in os.listdir(at))), ["dev@example.org"], "s", NOW)
    return _out(got, text="string").select("text", _us())


# probe files, claims, leaks


def _list_file(t, rows: list[dict], name: str) -> str:
    path = os.path.join(folder(t.spark, "inputs"), name)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(rows, f)
    return path


def _probes(t) -> list[dict]:
    return [r.asDict() for r in collect_bounded(t("fact_probes"), 10_000)]


@query("SELECT probe_id, question, expected, answerable, coalesce(notes, '') AS notes FROM fact_probes")
def fact_probe_file(t):
    return inputs.fact_probes(t.spark, _list_file(t, _probes(t), "facts.json"))


@query("SELECT probe_id, question AS prompt, NOT answerable AS should_decline, coalesce(notes, '') AS notes FROM fact_probes")
def refusal_probe_file(t):
    return inputs.refusal_probes(t.spark, _list_file(t, [{"probe_id": r["probe_id"], "prompt": r["question"], "should_decline": not r["answerable"], "notes": r["notes"]} for r in _probes(t)], "refusals.json"))


@query("SELECT substr(sha256('a model:2:' || question), 1, 16) AS claim_id, question AS text, 'a model' AS source_model, 2 AS run, coalesce(expected, '') AS evidence_quote, CASE WHEN answerable THEN 'high' ELSE 'unknown' END AS source_confidence, coalesce(notes, '') AS disconfirming_case FROM fact_probes")
def claims_file(t):
    rows = [{"text": r["question"], "evidence_quote": r["expected"], "disconfirming_case": r["notes"]} | ({"source_confidence": "high"} if r["answerable"] else {}) for r in _probes(t)]
    return inputs.claims(t.spark, _list_file(t, rows, "claims.json"), "a model", 2)


_LINES = "SELECT replace(trim(question), '|', '/') AS question, CASE WHEN answerable AND item_id % 5 > 0 THEN trim(expected) WHEN answerable THEN '???' ELSE '' END AS expected, answerable, coalesce(trim(notes), '') AS notes, item_id FROM fact_probes"


@query(f"SELECT 'f' || lpad((row_number() OVER (ORDER BY item_id))::VARCHAR, 3, '0') AS probe_id, question, expected, answerable, notes FROM ({_LINES}) WHERE expected <> '???'")
def probe_lines(t):
    """Probes in lines between bars, those still open left out."""
    rows = sorted(_probes(t), key=lambda r: r["item_id"])
    lines = ["# kind | question | expected | notes", ""]
    for r in rows:
        expected = "" if not r["answerable"] else r["expected"] if r["item_id"] % 5 else inputs.PLACEHOLDER
        lines.append(" | ".join(("A" if r["answerable"] else "u", r["question"].strip().replace("|", "/"), expected.strip(), (r["notes"] or "").strip())))
    got, _ = inputs.parse_probe_lines("\n".join(lines), skip_unfilled=True)
    return t.spark.createDataFrame([tuple(x[k] for k in ("probe_id", "question", "expected", "answerable", "notes")) for x in got], "probe_id string, question string, expected string, answerable boolean, notes string")


def _texts(path: str, rows: Iterator[dict]) -> None:
    with open(path, "w", encoding="utf-8", newline="") as f:
        for r in rows:
            f.write(r["text"] + "\n")


@query(r"SELECT trim(line, ' ' || chr(9)) AS line FROM (SELECT unnest(regexp_split_to_array(text, '\r\n|[\n\r\x0B\x0C\x1c-\x1e\x{85}\x{2028}\x{2029}]')) AS line FROM documents) WHERE contains(lower(line), 'bridge') OR contains(lower(line), 'garden')")
def leaked_lines(t):
    """Lines of a folder of texts that hold one of two words; a file of an allowed folder is not looked at."""
    at = folder(t.spark, "tree")
    os.makedirs(f"{at}/docs/.git")
    os.makedirs(f"{at}/config")
    for hidden in ("docs/.git/x.txt", "config/y.md", "z.bin"):
        with open(f"{at}/{hidden}", "w", encoding="utf-8") as f:
            f.write("a bridge\n")
    write_files(t("documents").where("text is not null").select("text"), f"{at}/docs", ".txt", _texts)
    return inputs.leak_lint(t.spark, at, ["Bridge", "garden", " "]).select("line")


# stores


@query(f"WITH d AS (SELECT subject_id, lower(trim(source)) AS source, source_id, count(*) AS copies FROM envelopes GROUP BY 1, 2, 3) SELECT source, count(*) AS n, sum(copies)::BIGINT - count(*) AS seen FROM d GROUP BY 1")
def vault_store(t):
    """Envelopes written source by source in two batches, early and late ones, each batch twice."""
    e = t("envelopes").withColumn("source", text.source_key(F.col("source")))
    v = corpus.Vault(t.spark, folder(t.spark, "vault"))
    late = F.col("ingested_at") >= split_now()
    out = []
    for s in sorted(r[0] for r in collect_bounded(e.select("source").distinct(), 100)):
        own = e.where(F.col("source") == s)
        before = sum(v.write(own.where(c))[1] for c in (~late, late))
        again = v.write(own)
        assert again[0] == 0
        out.append((s, v.count(s), before))
    return t.spark.createDataFrame(out, "source string, n bigint, seen bigint")


def _unique(t) -> DataFrame:
    d = t("turns").withColumn("source", text.source_key(F.col("source")))
    return d.groupBy("source", "source_id", "corpus_version").agg(F.min("turn_id").alias("turn_id")).select("turn_id").join(d, "turn_id")


@query(f"SELECT corpus_version AS version, source, source_id, row_number() OVER (PARTITION BY corpus_version ORDER BY ts NULLS FIRST, source_id, source) AS pos FROM (SELECT * EXCLUDE (source), {SRC} AS source FROM turns WHERE corpus_version IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {SRC}, source_id, corpus_version ORDER BY turn_id) = 1)")
def corpus_store(t):
    """All versions written and read back in order; ranks within a day plus the days before."""
    from pyspark.sql import Window

    d = _unique(t)
    store = corpus.CorpusStore(t.spark, folder(t.spark, "corpus"))
    for v in sorted(r[0] for r in collect_bounded(d.select("corpus_version").where("corpus_version is not null").distinct(), 100)):
        store.write(v, d.where(F.col("corpus_version") == v).select(*corpus.TURN_COLUMNS))
    out = None
    for v in store.versions():
        r = store.read(v).withColumn("day", F.coalesce(F.to_date("ts"), F.to_date(F.lit("0001-01-01"))))
        days = r.groupBy("day").count()
        days = days.withColumn("before", F.coalesce(F.sum("count").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
        r = r.withColumn("r", F.row_number().over(Window.partitionBy("day").orderBy("ts", "source_id", "source"))).join(days, "day")
        r = r.select(F.lit(v).alias("version"), "source", "source_id", (F.col("before") + F.col("r")).alias("pos"))
        out = r if out is None else out.unionByName(r)
    return out


@query("SELECT kind, count(*) AS n, sum(len(parents))::BIGINT AS n_parents, count(*) FILTER (coalesce(json_extract_string(payload, '$.reason'), '') = '') AS without_reason FROM ledger_entries GROUP BY 1")
def ledger_file(t):
    """The ledger written line by line and read back."""
    led = corpus.Ledger(os.path.join(folder(t.spark, "ledger"), "ledger.jsonl"))
    for r in collect_bounded(t("ledger_entries").orderBy("ts", "entry_id"), 100_000):
        led.append(r["kind"], r["subject_id"], json.loads(r["payload"]), list(r["parents"]), r["ts"].replace(tzinfo=timezone.utc))
    e = led.read(t.spark)
    reason = F.coalesce(F.get_json_object("payload", "$.reason"), F.lit(""))
    return e.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.size("parents")).cast("bigint").alias("n_parents"), F.count_if(reason == "").alias("without_reason"))


_BUILT = _BUILD.replace("k AS (SELECT pasted,", "k AS (SELECT source, source_id, thread_id, author_id, is_subject, text, pasted,")


@query(_BUILT + f" SELECT source, source_id, thread_id, is_subject, CASE WHEN is_subject THEN author_id ELSE {SQL['pseudonymize'].split('ELSE ')[1].split(' END')[0]} END AS author_id, {scrub_sql(scrub_sql('text'))} AS text FROM k WHERE NOT confidential AND NOT pasted")
def built_corpus(t):
    """Envelopes through vault, build and store to a published version."""
    e = t("envelopes").withColumn("source", text.source_key(F.col("source")))
    at = folder(t.spark, "build")
    v, store, led = corpus.Vault(t.spark, f"{at}/vault"), corpus.CorpusStore(t.spark, f"{at}/corpus"), corpus.Ledger(f"{at}/ledger.jsonl")
    v.write(e)
    corpus.build_corpus(v, store, led, "v1", "s", needles(t), "The Author", KEY)
    return store.read("v1").select("source", "source_id", "thread_id", "is_subject", "author_id", "text")


@query(SQL["golden_diff"].replace("SELECT count(*)", f"SELECT (SELECT count(*) FROM {VERSION.format('v3')}) AS frozen, count(*)", 1))
def golden_lifecycle(t):
    """Version 3 frozen and checked, then replaced by version 4 with a reason; the ledger keeps what changed."""
    d = _unique(t).withColumn("assisted", F.lit(False))
    at = folder(t.spark, "golden")
    store, led = corpus.CorpusStore(t.spark, f"{at}/corpus"), corpus.Ledger(f"{at}/ledger.jsonl")
    for v in ("v3", "v4"):
        store.write(v, d.where(F.col("corpus_version") == v).select(*corpus.TURN_COLUMNS))
    corpus.freeze(store, "v3", f"{at}/golden")
    n = corpus.load_golden(t.spark, f"{at}/golden").count()
    corpus.supersede(t.spark, store, led, "s", "v4", f"{at}/golden", "a later build", rebaseline=True)
    p = F.from_json("payload", "dropped bigint, added bigint, rewritten bigint, kept bigint")
    return led.read(t.spark).select(F.lit(n).cast("bigint").alias("frozen"), p.alias("p")).select("frozen", "p.*")


@query("WITH d AS (SELECT DISTINCT subject_id, source, source_id FROM envelopes) SELECT source, count(*) AS n FROM d GROUP BY 1")
def streamed_envelopes(t):
    """The envelope table as a stream of files into the vault, run twice."""
    from threadloom.streaming.ingest import stream_envelopes

    at = folder(t.spark, "stream")
    v = corpus.Vault(t.spark, f"{at}/vault")
    t("envelopes").write.parquet(f"{at}/arriving")
    for _ in range(2):
        stream_envelopes(t.spark, f"{at}/arriving", t("envelopes").schema, v, f"{at}/checkpoint").awaitTermination()
    return v.read().groupBy("source").agg(F.count("*").alias("n"))


# files for people


@query(f"SELECT line FROM ({SQL['worksheet_lines']})")
def worksheet_file(t):
    """The worksheet written as Markdown, and its lines read back from it."""
    from threadloom.operators import evaluation as ev

    d = ops.split_corpus(t("turns"), split_now()).where("text is not null").withColumn("source_id", F.col("turn_id").cast("string"))
    lines = ev.worksheet_lines(d.where("split = 'train'"), d.where("split <> 'train'"), categories=CLAIMS, sensitive=WITHHELD)
    path = os.path.join(folder(t.spark, "probes"), "worksheet.md")
    report.write_text(path, report.worksheet("a test", lines, ev.topics(t("documents")), 0, 0, 0, CLAIMS))
    with open(path, encoding="utf-8") as f:
        seeds = inputs.worksheet_seeds(f.read(), tuple(CLAIMS))
    return t.spark.createDataFrame([(x,) for x in seeds], "line string")


@query(f"SELECT entity, attribute, entity_hits, attribute_hits FROM ({SQL['absences']}) WHERE skipped IS NULL")
def absence_file(t):
    """Candidates written as JSON and read back."""
    from threadloom.operators import evaluation as ev

    path = os.path.join(folder(t.spark, "probes"), "absence-candidates.json")
    report.absence_file(ev.absence_candidates(t("documents"), ENTITIES), path)
    return t.spark.read.schema("entity string, attribute string, entity_hits bigint, attribute_hits bigint").option("multiLine", True).json(path)


@query(f"SELECT entity || ' ' || entity_hits || 'x train, ' || attribute || ' ' || attribute_hits || 'x' AS notes, question FROM ({SQL['answerable_rows']}) JOIN (VALUES " + ", ".join(f"('{e}', '{k}', '{q.replace('{e}', e)}')" for e, kind in ENTITIES.items() for k, _, q in ATTRIBUTES.get(kind, [])) + ") AS q(entity, attribute, question) USING (entity, attribute)")
def draft_file(t):
    """The draft of probes written, filled in, and parsed again."""
    from threadloom.operators import evaluation as ev

    body, _ = report.draft(["a line"], ev.answerable_rows(t("documents"), ENTITIES))
    filled = body.replace(f"| {inputs.PLACEHOLDER} |", "| an answer |")
    got, _ = inputs.parse_probe_lines(filled, skip_unfilled=True)
    return t.spark.createDataFrame([(x["notes"], x["question"]) for x in got], "notes string, question string")


_MERGED = """
WITH RECURSIVE a AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(regexp_replace(lower(question), '[^a-z ]', '', 'g'), ' +'), lambda x: x <> '')) AS w FROM fact_probes),
o AS (SELECT * FROM a WHERE item_id % 3 = 0),
p AS (SELECT *, row_number() OVER (ORDER BY item_id) AS i FROM a WHERE item_id % 3 <> 0),
g AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS item_id, NULL::BOOLEAN AS kept, (SELECT list(w) FROM o) AS words
  UNION ALL SELECT p.i, p.item_id, NOT d.dup, CASE WHEN d.dup THEN g.words ELSE list_append(g.words, p.w) END
  FROM g JOIN p ON p.i = g.i + 1, LATERAL (SELECT len(p.w) > 0 AND len(list_filter(g.words, lambda e: len(e) > 0 AND len(list_intersect(e, p.w)) / (len(e) + len(p.w) - len(list_intersect(e, p.w))) >= 0.25)) > 0 AS dup) d),
n AS (SELECT item_id, row_number() OVER (ORDER BY item_id) AS k FROM o UNION ALL SELECT item_id, (SELECT count(*) FROM o) + row_number() OVER (ORDER BY i) FROM g WHERE kept)
SELECT item_id, 'fact-' || lpad(k::VARCHAR, 3, '0') AS probe_id FROM n
"""


@query(_MERGED)
def merged_probes(t):
    """Two thirds of the probes merged into a file that holds the others; new ids go on where the old ones end."""
    rows = sorted(_probes(t), key=lambda r: r["item_id"])
    old = [r | {"probe_id": f"fact-{i:03d}"} for i, r in enumerate((r for r in rows if r["item_id"] % 3 == 0), 1)]
    kept, _, _ = report.merge_probes(old, [r for r in rows if r["item_id"] % 3], 0.25)
    return t.spark.createDataFrame([(r["item_id"], r["probe_id"]) for r in kept], "item_id bigint, probe_id string")


__all__ = ["QUERIES", "SQL"]
