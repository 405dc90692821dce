"""Python data sources: SQLite tables, growing line files, mailboxes and git logs, one or more partitions per file."""

from __future__ import annotations

import email.policy
import email.utils
import glob
import json
import mailbox
import os
import sqlite3
import subprocess
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

ROWS_PER_PART = 500_000
BYTES_PER_PART = 64 << 20


def files_of(paths: str, pattern: str | None = None) -> list[str]:
    """Files named by comma-separated paths; folders are searched for the pattern.  A missing path is an error, not an empty source."""
    out: list[str] = []
    for p in (x.strip() for x in paths.split(",") if x.strip()):
        if os.path.isdir(p) and pattern:
            out += glob.glob(os.path.join(p, "**", pattern), recursive=True)
        elif os.path.exists(p):
            out.append(p)
        else:
            raise FileNotFoundError(p)
    return sorted(dict.fromkeys(out))


@dataclass
class Span(InputPartition):
    path: str
    lo: int
    hi: int


class SqliteSource(DataSource):
    """``path``, ``table``, ``columns`` (name type, ...), optional ``after`` (rowid): rows with ``rowid`` first, read-only, cut by rowid ranges."""

    @classmethod
    def name(cls) -> str:
        return "threadloom_sqlite"

    def schema(self) -> str:
        return "rowid bigint, " + self.options["columns"]

    def reader(self, schema):
        return _SqliteReader(self.options)


class _SqliteReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.table, self.after = options["path"], options["table"], int(options.get("after", -1))
        self.names = [c.split()[0] for c in options["columns"].split(",")]
        if not all(x.replace("_", "").isalnum() for x in [self.table, *self.names]):
            raise ValueError("bad table or column name")

    def _open(self):
        if not os.path.exists(self.path):
            raise FileNotFoundError(self.path)
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self):
        with self._open() as c:
            lo, hi = c.execute(f"SELECT min(rowid), max(rowid) FROM {self.table} WHERE rowid > ?", (self.after,)).fetchone()
        if lo is None:
            return [Span(self.path, 0, 0)]
        return [Span(self.path, a, min(a + ROWS_PER_PART, hi + 1)) for a in range(lo, hi + 1, ROWS_PER_PART)]

    def read(self, part):
        with self._open() as c:
            yield from c.execute(f"SELECT rowid, {', '.join(self.names)} FROM {self.table} WHERE rowid >= ? AND rowid < ?", (part.lo, part.hi))


class TailSource(DataSource):
    """``path`` (files or folders of ``pattern``), optional ``cursor`` (JSON of path to byte offset): complete new lines of growing files.

    Rows ``(path, offset, mtime, line)``.  A last line without newline is left for
    the next run.  Reads as a batch or as a stream whose offsets are the cursor.
    """

    @classmethod
    def name(cls) -> str:
        return "threadloom_tail"

    def schema(self) -> str:
        return "path string, offset bigint, mtime timestamp, line string"

    def reader(self, schema):
        return _TailReader(self.options)

    def streamReader(self, schema):
        return _TailStream(self.options)


def complete_until(path: str) -> int:
    """Byte position after the last newline."""
    size = os.path.getsize(path)
    with open(path, "rb") as f:
        end = size
        while end > 0:
            start = max(0, end - (1 << 16))
            f.seek(start)
            at = f.read(end - start).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            end = start
    return 0


def lines_between(path: str, lo: int, hi: int) -> Iterator[tuple]:
    """Lines that begin in [lo, hi): the one running at ``lo`` belongs to the part before."""
    mtime = datetime.fromtimestamp(os.path.getmtime(path), timezone.utc)
    stop = complete_until(path)
    with open(path, "rb") as f:
        if lo:
            f.seek(lo - 1)
            if f.read(1) != b"\n":
                f.readline()
        while (at := f.tell()) < min(hi, stop):
            yield path, at, mtime, f.readline().rstrip(b"\r\n").decode("utf-8", "replace")


class _TailReader(DataSourceReader):
    def __init__(self, options):
        self.options = options
        self.seen = json.loads(options.get("cursor") or "{}")

    def partitions(self):
        out = []
        for p in files_of(self.options["path"], self.options.get("pattern", "*.jsonl")):
            lo, hi = self.seen.get(p, 0), complete_until(p)
            out += [Span(p, a, min(a + BYTES_PER_PART, hi)) for a in range(lo, hi, BYTES_PER_PART)]
        return out or [Span("", 0, 0)]

    def read(self, part):
        if part.path:
            yield from lines_between(part.path, part.lo, part.hi)


class _TailStream(DataSourceStreamReader):
    """Offsets are byte positions by file; the bytes between two of them are cut into parts that tasks read."""

    def __init__(self, options):
        self.options = options

    def initialOffset(self):
        return json.loads(self.options.get("cursor") or "{}")

    def latestOffset(self):
        return {p: complete_until(p) for p in files_of(self.options["path"], self.options.get("pattern", "*.jsonl"))}

    def partitions(self, start, end):
        out = [Span(p, a, min(a + BYTES_PER_PART, hi)) for p, hi in sorted(end.items()) for a in range(start.get(p, 0), hi, BYTES_PER_PART)]
        return out or [Span("", 0, 0)]

    def read(self, part):
        if part.path:
            yield from lines_between(part.path, part.lo, part.hi)


class MboxSource(DataSource):
    """``path``, optional ``cursor`` (JSON of path to last index): one row per message, a partition per mailbox.

    ``(path, idx, message_id, sender, to, subject, date, body, error)``; ``date`` is
    null if it cannot be read.  A message that cannot be parsed has its error and no body.
    """

    @classmethod
    def name(cls) -> str:
        return "threadloom_mbox"

    def schema(self) -> str:
        return "path string, idx bigint, message_id string, sender string, to string, subject string, date timestamp, body string, error string"

    def reader(self, schema):
        return _MboxReader(self.options)


def plain_body(msg) -> str:
    """The first text/plain part in its declared charset, bytes that do not fit left out."""
    part = next((p for p in msg.walk() if p.get_content_type() == "text/plain" and not p.is_multipart()), None)
    if part is None:
        return ""
    raw = part.get_payload(decode=True)
    if raw is None:
        return str(part.get_payload() or "")
    try:
        return raw.decode(part.get_content_charset() or "utf-8", "ignore")
    except (LookupError, TypeError):
        return raw.decode("utf-8", "ignore")


def mail_date(value: str | None) -> datetime | None:
    try:
        d = email.utils.parsedate_to_datetime(value)
        return d.replace(tzinfo=timezone.utc) if d.tzinfo is None else d.astimezone(timezone.utc)
    except (TypeError, ValueError):
        return None


class _MboxReader(DataSourceReader):
    def __init__(self, options):
        self.options = options
        self.seen = json.loads(options.get("cursor") or "{}")

    def partitions(self):
        return [Span(p, self.seen.get(p, -1), 0) for p in files_of(self.options["path"], "*.mbox")]

    def read(self, part):
        for i, msg in enumerate(mailbox.mbox(part.path, create=False)):
            if i <= part.lo:
                continue
            try:
                text = lambda h: None if msg.get(h) is None else str(msg.get(h))
                yield part.path, i, text("Message-ID"), email.utils.parseaddr(text("From") or "")[1].lower(), text("To") or "", text("Subject") or "", mail_date(text("Date")), plain_body(msg), None
            except Exception as e:  # a bad message must not end the mailbox
                yield part.path, i, None, None, None, None, None, None, str(e)[:200]


class GitSource(DataSource):
    """``path`` (repositories), optional ``cursor`` (JSON of repository to commit): commits oldest first, a partition per repository.

    ``(repo, pos, sha, email, ts, body)``.  A cursor that is gone means a full scan;
    an empty repository has no rows; a folder that is none is an error.
    """

    @classmethod
    def name(cls) -> str:
        return "threadloom_git"

    def schema(self) -> str:
        return "repo string, pos bigint, sha string, email string, ts timestamp, body string"

    def reader(self, schema):
        return _GitReader(self.options)


class _GitReader(DataSourceReader):
    def __init__(self, options):
        self.repos = [x.strip() for x in options["path"].split(",") if x.strip()]
        self.seen = json.loads(options.get("cursor") or "{}")

    def partitions(self):
        return [Span(r, 0, 0) for r in self.repos]

    def _git(self, repo, *args):
        return subprocess.run(["git", "-c", "safe.directory=*", "-C", repo, *args], capture_output=True, text=True, encoding="utf-8", errors="replace")

    def read(self, part):
        repo, since = part.path, self.seen.get(part.path)
        if self._git(repo, "rev-parse", "--git-dir").returncode:
            raise OSError(f"not a repository: {repo}")
        fmt = "--format=%H%x1f%aI%x1f%ae%x1f%B%x00"
        got = self._git(repo, "log", "--reverse", fmt, f"{since}..HEAD") if since else None
        if got is None or got.returncode:
            got = self._git(repo, "log", "--reverse", fmt)
        if got.returncode:
            if self._git(repo, "rev-parse", "--verify", "HEAD").returncode:
                return
            raise OSError(got.stderr[:300])
        for i, c in enumerate(x for x in got.stdout.split("\0") if x.strip()):
            sha, iso, mail, body = c.strip("\n").split("\x1f", 3)
            yield repo, i, sha, mail, datetime.fromisoformat(iso).astimezone(timezone.utc), body.strip()


def register(spark: SparkSession) -> None:
    for s in (SqliteSource, TailSource, MboxSource, GitSource):
        spark.dataSource.register(s)
