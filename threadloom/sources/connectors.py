"""Connectors: each source's export to envelopes ``(subject_id, source, source_id, ts, ingested_at, payload)``."""

from __future__ import annotations

import io
import json
import os
import zipfile
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.functions.text import apple_time, is_blank, looks_pasted, short_hash, strip_fences, strip_quoted, strip_tags, trim_u
from threadloom.operators.provenance import live_branch
from threadloom.sources.blobs import decode_body_udf
from threadloom.sources.tables import files_of, register


def _envelope(df: DataFrame, subject_id: str, source: str, now: datetime, payload: list[Column]) -> DataFrame:
    """``now`` stands in for times that are missing, so a repeated run gives the same rows."""
    return df.select(
        F.lit(subject_id).alias("subject_id"), F.lit(source).alias("source"), "source_id", F.coalesce("ts", F.lit(now)).alias("ts"), F.lit(now).alias("ingested_at"), F.to_json(F.struct(*payload)).alias("payload")
    )


def chat_database(spark: SparkSession, path: str, subject_id: str, now: datetime, after: int = -1) -> DataFrame:
    """Messages of a chat database after a row id, text or decoded body, both directions; blank ones are dropped.

    A message in several chats takes the chat with the smallest guid.
    """
    register(spark)
    read = lambda t, c, **o: spark.read.format("threadloom_sqlite").options(path=path, table=t, columns=c, **o).load()
    m = read("message", "text string, attributedBody binary, is_from_me int, date bigint, handle_id bigint", after=str(after))
    h = read("handle", "id string").select(F.col("rowid").alias("handle_id"), F.col("id").alias("handle"))
    j = read("chat_message_join", "chat_id bigint, message_id bigint").select("chat_id", F.col("message_id").alias("mid"))
    c = read("chat", "guid string").select(F.col("rowid").alias("chat_id"), F.col("guid").alias("chat_guid"))
    chat = j.join(c, "chat_id", "left").groupBy("mid").agg(F.min("chat_guid").alias("chat_guid"))
    has = ~is_blank(F.col("text"))
    m = m.where(has).unionByName(m.where(~has).withColumn("text", decode_body_udf(F.col("attributedBody"))))
    m = m.where(~is_blank(F.col("text"))).join(h, "handle_id", "left").join(chat, F.col("rowid") == F.col("mid"), "left")
    m = m.withColumns({"source_id": F.col("rowid").cast("string"), "ts": apple_time(F.col("date")), "is_from_me": F.col("is_from_me") == 1, "handle": F.coalesce("handle", F.lit("unknown")), "chat_guid": F.coalesce("chat_guid", F.lit("unknown"))})
    return _envelope(m, subject_id, "imessage", now, ["text", "is_from_me", "handle", "chat_guid"])


def recovery(spark: SparkSession, path: str, gate: float = 0.95) -> DataFrame:
    """Rows, blank texts, blank texts with a body, bodies decoded, rate (1 without bodies) and whether it reaches the gate."""
    register(spark)
    m = spark.read.format("threadloom_sqlite").options(path=path, table="message", columns="text string, attributedBody binary").load()
    blank = is_blank(F.col("text"))
    body = blank & F.col("attributedBody").isNotNull()
    m = m.where(~body).withColumn("got", F.lit(None).cast("string")).unionByName(m.where(body).withColumn("got", decode_body_udf(F.col("attributedBody"))))
    a = m.agg(F.count("*").alias("n_rows"), F.count_if(blank).alias("n_blank"), F.count_if(body).alias("n_bodies"), F.count_if(body & F.col("got").isNotNull()).alias("n_decoded"))
    rate = F.coalesce(F.col("n_decoded") / F.nullif(F.col("n_bodies"), F.lit(0)), F.lit(1.0))
    return a.withColumn("rate", rate).withColumn("passed", F.col("rate") >= gate)


def transcript_rows(lines: DataFrame) -> DataFrame:
    """Lines ``(path, offset, mtime, line)`` of session transcripts to typed user text; bad JSON and other entries are skipped."""
    v = F.try_parse_json("line")
    t = lines.withColumn("v", v).where(F.try_variant_get("v", "$.type", "string") == "user").withColumn("c", F.try_variant_get("v", "$.message.content", "variant"))
    kind = F.schema_of_variant("c")  # a string is text whatever it looks like; only a list has parts
    parts = F.filter(F.try_variant_get("c", "$", "array<variant>"), lambda p: F.try_variant_get(p, "$.type", "string") == "text")
    joined = F.array_join(F.transform(parts, lambda p: F.coalesce(F.try_variant_get(p, "$.text", "string"), F.lit(""))), "\n")
    text = F.when(kind == "STRING", F.try_variant_get("c", "$", "string")).when(kind.startswith("ARRAY"), joined)
    t = t.withColumn("typed", text).drop("v", "c").withColumnRenamed("typed", "c")
    t = t.withColumn("raw", trim_u(strip_tags(F.col("c")))).where(~is_blank(F.col("raw"))).withColumn("text", strip_fences(F.col("raw")))
    t = t.withColumns({"raw_chars": F.length("raw"), "prose_chars": F.length("text"), "looks_pasted": looks_pasted(F.col("raw"), F.col("text"))})
    return t.withColumn("source_id", short_hash(24, F.col("path"), F.col("offset").cast("string"), F.col("raw"))).withColumn("ts", F.col("mtime"))


def transcripts(spark: SparkSession, path: str, subject_id: str, now: datetime, cursor: str | None = None) -> tuple[DataFrame, str]:
    """New complete lines of all transcripts, and the cursor after them."""
    from threadloom.sources.tables import complete_until

    register(spark)
    files = files_of(path, "*.jsonl")
    seen = json.loads(cursor or "{}")
    t = transcript_rows(spark.read.format("threadloom_tail").options(path=path, cursor=cursor or "{}").load())
    e = _envelope(t, subject_id, "claude_code", now, ["text", F.col("path").alias("file"), "raw_chars", "prose_chars", "looks_pasted"])
    return e, json.dumps(seen | {f: complete_until(f) for f in files}, sort_keys=True)


def unseen_exports(paths: str, cursor: str | None) -> tuple[list[str], str]:
    """Snapshot files whose size is not the recorded one, and the cursor with all sizes."""
    files = files_of(paths, "*")
    seen = json.loads(cursor or "{}")
    sizes = {f: os.path.getsize(f) for f in files}
    return [f for f in files if seen.get(f) != sizes[f]], json.dumps(seen | sizes, sort_keys=True)


def _documents(spark: SparkSession, files: list[str], member: str | None) -> DataFrame:
    """``(path, json)`` of JSON files, or of the named member of zip files; anything but a list or object is an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                raw = bytes(content)
                if zipfile.is_zipfile(io.BytesIO(raw)):
                    with zipfile.ZipFile(io.BytesIO(raw)) as z:
                        names = [n for n in z.namelist() if os.path.basename(n) == member]
                        if not names:
                            raise ValueError(f"no {member} in {path}")
                        raw = z.read(names[0])
                out.append((path.removeprefix("file:"), raw.decode("utf-8")))
            yield pd.DataFrame(out, columns=["path", "json"])

    if not files:
        return spark.createDataFrame([], "path string, json string")
    return spark.read.format("binaryFile").load(files).select("path", "content").mapInPandas(run, "path string, json string")


def _parsed(docs: DataFrame, schema: str, opening: str) -> DataFrame:
    v = F.from_json("json", schema, {"mode": "FAILFAST"})
    bad = F.raise_error(F.concat(F.lit("not the expected JSON: "), F.col("path")))
    return docs.select("path", F.when(F.col("json").rlike(rf"^[\s\x{{FEFF}}]*\{opening}"), v).otherwise(bad.cast(schema)).alias("v"))


def _iso(c: Column) -> Column:
    return F.try_to_timestamp(F.regexp_replace(c, "Z$", "+00:00"))


def _pasted(df: DataFrame) -> DataFrame:
    p = strip_fences(F.col("text"))
    return df.withColumns({"raw_chars": F.length("text"), "prose_chars": F.length(p), "looks_pasted": looks_pasted(F.col("text"), p)})


def zip_export(spark: SparkSession, paths: str, subject_id: str, now: datetime, cursor: str | None = None) -> tuple[DataFrame, str]:
    """Human messages of zipped or bare conversation lists; attachments are counted, not kept."""
    files, after = unseen_exports(paths, cursor)
    msg = "struct<uuid:string,sender:string,text:string,content:array<struct<type:string,text:string>>,created_at:string,parent_message_uuid:string,attachments:array<struct<extracted_content:string>>,files:array<string>>"
    d = _parsed(_documents(spark, files, "conversations.json"), f"array<struct<uuid:string,name:string,chat_messages:array<{msg}>>>", "[")
    m = d.select("path", F.explode("v").alias("c")).select("path", "c.uuid", "c.name", F.posexplode("c.chat_messages").alias("idx", "m")).where("m.sender = 'human'")
    blocks = F.array_join(F.transform(F.filter(F.coalesce("m.content", F.array()), lambda b: b["type"] == "text"), lambda b: F.coalesce(b["text"], F.lit(""))), "\n")
    m = m.withColumn("text", trim_u(F.when(~is_blank(F.col("m.text")), F.col("m.text")).otherwise(blocks))).where(~is_blank(F.col("text")))
    ids = F.when(~is_blank(F.col("m.uuid")), F.col("m.uuid")).otherwise(short_hash(24, F.col("path"), F.col("uuid"), F.col("idx").cast("string"), F.col("text")))
    att = F.coalesce("m.attachments", F.array())
    m = _pasted(m.withColumns({
        "source_id": ids, "ts": _iso(F.col("m.created_at")), "conversation_uuid": F.col("uuid"), "parent_message_uuid": F.col("m.parent_message_uuid"), "attachment_count": F.size(att), "file_count": F.size(F.coalesce("m.files", F.array())),
        "attachment_chars": F.aggregate(att, F.lit(0), lambda n, a: n + F.length(F.coalesce(a["extracted_content"], F.lit("")))), "sender": F.col("m.sender"),
    }))
    return _envelope(m, subject_id, "claude_ai", now, ["text", "conversation_uuid", "sender", "parent_message_uuid", "name", "raw_chars", "prose_chars", "looks_pasted", "attachment_count", "attachment_chars", "file_count"]), after


def query_export(spark: SparkSession, paths: str, subject_id: str, now: datetime, cursor: str | None = None) -> tuple[DataFrame, str]:
    """Queries of a search export; their status is kept as data."""
    files, after = unseen_exports(paths, cursor)
    entry = "struct<entry_uuid:string,query:string,created_at:string,query_status:string,engine_mode:string>"
    d = _parsed(_documents(spark, files, None), f"struct<conversations:array<struct<context_uuid:string,context_title:string,entries:array<{entry}>>>>", "{")
    m = d.select("path", F.explode("v.conversations").alias("c")).select("path", "c.context_uuid", "c.context_title", F.posexplode("c.entries").alias("idx", "m"))
    m = m.withColumn("text", trim_u(F.col("m.query"))).where(~is_blank(F.col("text")))
    ids = F.when(~is_blank(F.col("m.entry_uuid")), F.col("m.entry_uuid")).otherwise(short_hash(24, F.col("path"), F.col("context_uuid"), F.col("idx").cast("string"), F.col("text")))
    m = _pasted(m.withColumns({"source_id": ids, "ts": _iso(F.col("m.created_at")), "query_status": F.col("m.query_status"), "engine_mode": F.col("m.engine_mode")}))
    return _envelope(m, subject_id, "perplexity", now, ["text", "context_uuid", "context_title", "query_status", "engine_mode", "raw_chars", "prose_chars", "looks_pasted"]), after


def graph_export(spark: SparkSession, paths: str, subject_id: str, now: datetime, cursor: str | None = None) -> tuple[DataFrame, str]:
    """User messages on the live branch of every conversation graph; time falls back to the conversation's, then to 1970."""
    files, after = unseen_exports(paths, cursor)
    msg = "struct<id:string,author:struct<role:string>,content:struct<content_type:string,parts:array<variant>>,create_time:double,metadata:struct<model_slug:string,is_user_system_message:boolean>>"
    d = _parsed(_documents(spark, files, None), f"array<struct<conversation_id:string,id:string,title:string,create_time:double,current_node:string,mapping:map<string,struct<parent:string,message:{msg}>>>>", "[")
    c = d.select("path", F.posexplode("v").alias("cpos", "c")).select("path", F.coalesce("c.conversation_id", "c.id", F.lit("")).alias("conversation_id"), F.concat_ws(":", "path", F.col("cpos").cast("string")).alias("k"), "c.title", F.col("c.create_time").alias("ctime"), "c.current_node", "c.mapping")
    b = live_branch(c.select(F.col("k").alias("conversation_id"), "current_node", "mapping")).withColumnRenamed("conversation_id", "k")
    m = c.join(b, "k").select("path", "conversation_id", "title", "ctime", "mapping", F.posexplode("branch").alias("idx", "node")).withColumn("m", F.col("mapping")[F.col("node")]["message"])
    m = m.where("m.author.role = 'user' and m.content.content_type in ('text', 'multimodal_text') and not coalesce(m.metadata.is_user_system_message, false)")
    parts = F.coalesce("m.content.parts", F.array().cast("array<variant>"))
    typed = F.transform(parts, lambda p: F.when(F.schema_of_variant(p) == "STRING", F.try_variant_get(p, "$", "string")))
    m = m.withColumn("text", F.array_join(F.array_compact(typed), "")).where(~is_blank(F.col("text")))
    ids = F.when(~is_blank(F.col("m.id")), trim_u(F.col("m.id"))).otherwise(short_hash(24, F.col("path"), F.col("conversation_id"), F.col("idx").cast("string"), F.col("text")))
    when_ = F.timestamp_micros(F.floor(F.coalesce("m.create_time", "ctime", F.lit(0.0)) * 1_000_000).cast("bigint"))
    m = _pasted(m.withColumns({"source_id": ids, "ts": when_, "role": F.lit("user"), "model_slug": F.col("m.metadata.model_slug"), "image_count": F.size(F.filter(parts, lambda p: F.try_variant_get(p, "$.content_type", "string") == "image_asset_pointer"))}))
    return _envelope(m, subject_id, "chatgpt", now, ["text", "conversation_id", "role", "title", "raw_chars", "prose_chars", "looks_pasted", "model_slug", "image_count"]), after


def mailboxes(spark: SparkSession, path: str, addresses: list[str], subject_id: str, now: datetime, cursor: str | None = None) -> tuple[DataFrame, str]:
    """Mail sent from one of the addresses, quotations stripped; a Message-ID seen before gets ``path:index``."""
    register(spark)
    m = spark.read.format("threadloom_mbox").options(path=path, cursor=cursor or "{}").load()
    seen = json.loads(cursor or "{}") | {r["path"]: r["i"] for r in m.groupBy("path").agg(F.max("idx").alias("i")).collect()}
    m = m.where(F.col("error").isNull() & F.col("sender").isin([a.strip().lower() for a in addresses])).withColumn("text", strip_quoted(F.col("body"))).where(~is_blank(F.col("text")))
    w = Window.partitionBy("message_id").orderBy("path", "idx")
    place = F.concat_ws(":", "path", F.col("idx").cast("string"))
    first = (F.row_number().over(w) == 1) & F.col("message_id").isNotNull()
    m = m.withColumn("source_id", F.when(first, F.col("message_id")).otherwise(place)).withColumn("ts", F.col("date"))
    return _envelope(m, subject_id, "mail", now, ["text", "subject", "to"]), json.dumps(seen, sort_keys=True)


def git_log(spark: SparkSession, repos: str, emails: list[str], subject_id: str, now: datetime, cursor: str | None = None) -> tuple[DataFrame, str]:
    """Commit messages of the given authors, oldest first; the cursor is the last commit of each repository."""
    register(spark)
    g = spark.read.format("threadloom_git").options(path=repos, cursor=cursor or "{}").load()
    heads = {r["repo"]: r["h"]["sha"] for r in g.groupBy("repo").agg(F.max(F.struct("pos", "sha")).alias("h")).collect()}
    g = g.where(F.lower("email").isin([e.strip().lower() for e in emails])).withColumn("source_id", F.col("sha")).withColumn("text", F.col("body"))
    return _envelope(g, subject_id, "git_repos", now, ["text", "repo"]), json.dumps(json.loads(cursor or "{}") | heads, sort_keys=True)
