"""Problem 9: evaluation items that occur, whole or in part, in documents."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.words import WORD
from threadloom.session import Stage

LEAST = 12
#: The automaton is sent to every executor; items beyond this many words are searched in several passes.
PASS_WORDS = 500_000
#: Affected texts whose spans are sent to every executor (some 100 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 200_000


class _Plain(dict):
    """Code point to what remains of it: no accents, no invisible format characters."""

    def __missing__(self, c: int) -> str:
        out = "".join(x for x in unicodedata.normalize("NFD", chr(c)) if unicodedata.category(x) not in ("Mn", "Cf"))
        self[c] = out
        return out


PLAIN = _Plain()


def plain(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(PLAIN).lower().translate(PLAIN)


class Automaton:
    """Generalised suffix automaton of word sequences; states of ``least`` words or more know the items that hold them.

    A passage of so many words mostly belongs to one item, so what the states know
    grows with the words of the items, not with words times items.
    """

    def __init__(self, items: list[tuple[int, list[str]]], least: int = LEAST):
        self.vocab: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.items = [i for i, _ in items]
        self.words = [ws for _, ws in items]
        ends: dict[int, set[int]] = {}
        for n, (_, ws) in enumerate(items):
            last = 0
            for w in ws:
                last = self._extend(last, self.vocab.setdefault(w, len(self.vocab)))
                if self.len[last] >= least:
                    ends.setdefault(last, set()).add(n)
        for s in sorted((s for s in range(1, len(self.len)) if self.len[s] >= least), key=self.len.__getitem__, reverse=True):
            up = self.link[s]
            if s in ends and self.len[up] >= least:
                ends.setdefault(up, set()).update(ends[s])
        self.holds: dict[int, tuple[int, ...]] = {s: tuple(sorted(x)) for s, x in ends.items()}

    def _new(self, length: int, of: int | None = None) -> int:
        self.next.append(dict(self.next[of]) if of is not None else {})
        self.link.append(self.link[of] if of is not None else -1)
        self.len.append(length)
        return len(self.len) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        clone = self._new(self.len[p] + 1, q)
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.len[q] == self.len[last] + 1 else self._split(last, q, c)
        cur, p = self._new(self.len[last] + 1), last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p == -1:
            self.link[cur] = 0
        else:
            q = self.next[p][c]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, c)
        return cur

    def matches(self, ws: list[str], least: int) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of every position where the last ``least`` words or more occur in an item."""
        nxt, link, length, vocab = self.next, self.link, self.len, self.vocab
        s = n = 0
        for e, w in enumerate(ws):
            c = vocab.get(w)
            if c is None:
                s = n = 0
                continue
            t = nxt[s].get(c)
            while t is None and s:
                s = link[s]
                n = length[s]
                t = nxt[s].get(c)
            if t is None:
                n = 0
                continue
            s, n = t, n + 1
            if n >= least:
                yield e, n, s

    def shared(self, ws: list[str], least: int) -> Iterator[tuple[int, int, int, list[list[int]]]]:
        """Per item with a shared run of ``least`` words: (number, longest run, words of the item in such runs, stretches [begin, end) of the words)."""
        found: dict[int, list[list[int]]] = {}
        longest: dict[int, int] = {}
        for e, n, s in self.matches(ws, least):
            seen: set[int] = set()
            while s > 0 and n >= least:
                for i in self.holds.get(s, ()):
                    if i in seen:
                        continue
                    seen.add(i)
                    longest[i] = max(longest.get(i, 0), n)
                    runs = found.setdefault(i, [])
                    if runs and e - n + 1 <= runs[-1][1]:
                        runs[-1][1] = e + 1
                    else:
                        runs.append([e - n + 1, e + 1])
                s = self.link[s]
                n = self.len[s] if s > 0 else 0
        for i, runs in found.items():
            there = {tuple(ws[k : k + least]) for b, e in runs for k in range(b, e - least + 1)}
            own, covered, end = self.words[i], 0, 0
            for k in range(len(own) - least + 1):
                if tuple(own[k : k + least]) in there:
                    covered += k + least - max(k, end)
                    end = k + least
            yield i, longest[i], covered, runs


def _passes(probes: DataFrame) -> Iterator[list[tuple[int, list[str]]]]:
    """Items in groups of at most ``PASS_WORDS`` words, streamed to the driver."""
    group, n = [], 0
    for r in probes.where("item_id is not null and question is not null").select("item_id", "question").toLocalIterator():
        ws = WORD.findall(plain(r["question"]))
        if len(ws) >= LEAST:
            group.append((r["item_id"], ws))
            n += len(ws)
            if n >= PASS_WORDS:
                yield group
                group, n = [], 0
    if group:
        yield group


def _searched(docs: DataFrame, probes: DataFrame, found, schema: str) -> DataFrame:
    """``found(automaton, doc_id, words)`` rows over all documents.

    The automaton of one pass at a time is sent out: with more than one pass each is
    run to its end and its rows are written before the next automaton is made.
    """
    spark = docs.sparkSession
    names = [c.split()[0] for c in schema.split(", ")]
    out, sent = None, None
    for group in _passes(probes):
        if sent is not None:
            out = Stage(out, "leaks").df if out is not None else None
            sent.destroy()
        sent = spark.sparkContext.broadcast(Automaton(group))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            auto = sent.value
            for b in batches:
                rows = []
                for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                    rows += found(auto, d, WORD.findall(plain(t)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=names)

        part = docs.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def _documents(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")


def leaks(documents: DataFrame, probes: DataFrame) -> DataFrame:
    """One row per item and document that share at least 12 consecutive words.

    Columns: item_id, doc_id, n_words (longest shared run), coverage (part of the
    item that lies in any such run).  Accents and invisible format characters are
    removed on both sides.  A suffix automaton of the items reads each document once
    and keeps the longest match at every word, joined to runs.  Null and short texts
    match nothing; repeated items are found each; no items or no documents give no rows.
    """

    def found(auto: Automaton, d: int, ws: list[str]) -> list[tuple]:
        return [(auto.items[i], d, n, round(c / len(auto.words[i]), 6)) for i, n, c, _ in auto.shared(ws, LEAST)]

    return _searched(_documents(documents), probes, found, "item_id bigint, doc_id bigint, n_words bigint, coverage double")


def without_leaks(documents: DataFrame, probes: DataFrame, max_words: int = 24, max_coverage: float = 0.5) -> DataFrame:
    """Affected documents without the runs shared with an item of which they hold more than ``max_words`` words or more than ``max_coverage``.

    Columns: doc_id, n_spans, n_words_removed, text.  All runs of 12 or more words of
    such an item go, also further copies, with what stands between the words; the
    rest of the text stays as it is.  Documents without such a run give no row; one
    that stands in the table twice gives a row each time.
    """

    def found(auto: Automaton, d: int, ws: list[str]) -> list[tuple]:
        return [(d, s, e) for i, _, n, runs in auto.shared(ws, LEAST) if n > max_words or n > max_coverage * len(auto.words[i]) for s, e in runs]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for d, t, spans in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("spans").to_pylist()):
                ranges = sorted((x["s"], x["e"]) for x in spans)
                merged = [list(ranges[0])]
                for s, e in ranges[1:]:
                    if s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                at = _places(t)
                keep, pos = [], 0
                for s, e in merged:
                    keep.append(t[pos : at[s][0]])
                    pos = at[e - 1][1]
                rows.append((d, len(merged), sum(e - s for s, e in merged), "".join(keep) + t[pos:]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["doc_id", "n_spans", "n_words_removed", "text"])

    docs = _documents(documents).withColumn("mark", F.xxhash64("text"))
    # spans belong to a text: documents of equal text have the same ones
    spans = _searched(docs.select(F.col("mark").alias("doc_id"), "text"), probes, found, "doc_id bigint, s bigint, e bigint")
    spans = Stage(spans.groupBy(F.col("doc_id").alias("mark")).agg(F.collect_set(F.struct("s", "e")).alias("spans")), "spans").df
    few = spans.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(spans) if few else spans, "mark").select("doc_id", "text", "spans").mapInArrow(cut, "doc_id bigint, n_spans bigint, n_words_removed bigint, text string")


def _places(text: str) -> list[tuple[int, int]]:
    """Where in the text each word of its plain form begins and ends."""
    out, buf, src = [], [], []
    for i, ch in enumerate(text):
        for x in plain(ch):
            buf.append(x)
            src.append(i)
    for m in WORD.finditer("".join(buf)):
        out.append((src[m.start()], src[m.end() - 1] + 1))
    return out
