"""Runs of words that evaluation texts share with training texts, read off sorted suffixes.

1. One pass gives every text its words as hashes in their order.  A task sends the
   words of a text and side once, copies of it only name their sequence.
2. A suffix can have a neighbour of the other side with ``SHINGLE`` words in common
   only if its first ``SHINGLE`` words stand on both sides.  All suffixes of all texts
   go, packed, to the task that their first words name; it marks those.  Keys that one
   text in ``SHARE`` holds are not sent: their sides are collected beforehand.
3. Consecutive marked suffixes and their words are a *stretch*; nothing outside it can
   match the other side.  Equal stretches of all texts are one row.
4. The suffixes of the stretches are sorted by their words, up to ``DEPTH`` of them.
   For each evaluation suffix the next training suffixes before and after it in this
   order are read, with the length of the common prefix.  Where more than ``DEPTH``
   words are common, the suffixes that follow in the text carry the run on, so the
   union of the prefixes is exact at any length.
5. The prefixes are merged to the words covered, first per stretch, then per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm import words as W
from threadloom.llm.near import HOT, SHARE, small
from threadloom.session import Stage

#: Words of a run that counts as shared.
SHINGLE = 8
#: Words by which suffixes are sorted.
DEPTH = 64
#: The suffixes are marked in so many parts, one after the other, which bounds the shuffle files.
PARTS = 4
RECORDS_PER_TASK, TAILS_PER_TASK = 1_000_000, 100_000
#: Hot keys are counted on one text in so many.
SAMPLE = 16

RECORD = np.dtype([("key", "<u8"), ("seq", "<i8"), ("at", "<u4"), ("side", "u1")])
TAIL = np.dtype([("key", "<u8"), ("ext", "<i8"), ("at", "<u4"), ("tr", "?"), ("ev", "?"), ("n", "u1")])


def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(turn_id, text, side) to (turn_id, side, seq, n, words in order); the words are null where the task gave them before."""
    h, seen = W.Hasher(), set()
    for b in batches:
        rows, seq, n, new, flat = [], [], [], [], []
        for i, (t, s) in enumerate(zip(b.column("text").to_pylist(), b.column("side").to_pylist())):
            w = W.words(t)
            if len(w) < W.MIN_WORDS or len(set(w)) < W.MIN_WORDS:
                continue
            q = xxhash.xxh3_64_intdigest(" ".join(w))
            if first := (q, s) not in seen:
                if len(seen) >= W.SEEN:
                    seen.clear()
                seen.add((q, s))
                flat += [h[x] for x in w]
            rows.append(i)
            seq.append(q)
            n.append(len(w))
            new.append(first)
        if not rows:
            continue
        size, new = np.array(n, np.int32), np.array(new)
        ends = np.cumsum(size[new], dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(np.array(flat, np.uint64).view(np.int64)))
        lists = lists.take(pa.array(np.where(new, np.cumsum(new) - 1, 0), mask=~new))
        cols = [b.column(c).take(pa.array(rows)) for c in ("turn_id", "side")]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(np.array(seq, np.uint64).view(np.int64)), pa.array(size), lists], names=["turn_id", "side", "seq", "n", "words"])


SEQUENCES = "turn_id bigint, side int, seq bigint, n int, words array<bigint>"


def heads(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, position) of every suffix with ``SHINGLE`` words or more; the key is a hash of the first of them."""
    n = max(0, flat.size - SHINGLE + 1)
    key = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        key = key * W.M2 + flat[i : i + n]
    row = np.repeat(np.arange(sizes.size), sizes)[:n]
    at = np.arange(n) - starts[row]
    ok = at + SHINGLE <= sizes[row]
    return W.mix(W.mix(key[ok], W.M1), W.M3), row[ok], at[ok]


def _sent(task: np.ndarray, rec: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Records ordered by task: (order, first of each task, end of each task, tasks)."""
    o = np.argsort(task, kind="stable")
    t = task[o]
    cut = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1]))) if t.size else np.empty(0, np.int64)
    return o, cut, np.append(cut[1:], t.size) if t.size else cut, t[cut]


def _within(keys: np.ndarray, some: np.ndarray) -> np.ndarray:
    return some[np.minimum(np.searchsorted(some, keys), some.size - 1)] == keys if some.size else np.zeros(keys.size, bool)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that more than one text in ``4 * SHARE`` of a batch begins a suffix with: (key, n)."""
    for b in batches:
        key, row, _ = heads(*W.flat_words(b))
        u, n = np.unique(key, return_counts=True)
        many = n >= max(2, b.num_rows // (4 * SHARE))
        yield pa.RecordBatch.from_arrays([pa.array(u[many].view(np.int64)), pa.array(n[many])], names=["key", "n"])


def sides_of(hot: np.ndarray):
    """Sides on which the hot keys stand: (key, side)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, row, _ = heads(*W.flat_words(b))
            side = b.column("side").to_numpy()[row]
            for s in (0, 1):
                k = key[side == s]
                u = np.unique(k[_within(k, hot)])
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(np.full(u.size, s, np.int32))], names=["key", "side"])

    return run


def suffix_heads(part: int, parts: int, tasks: int, hot: np.ndarray):
    """Records of the suffixes whose keys fall into the part: (task, records as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, row, at = heads(*W.flat_words(b))
            own = (key % np.uint64(parts) == part) & ~_within(key, hot)
            key, row, at = key[own], row[own], at[own]
            rec = np.empty(key.size, RECORD)
            rec["key"], rec["at"] = key, at
            rec["seq"], rec["side"] = (b.column(c).to_numpy()[row] for c in ("seq", "side"))
            o, cut, end, task = _sent(((key >> np.uint64(32)) % np.uint64(tasks)).astype(np.int32), rec)
            rec = rec[o]
            yield pa.RecordBatch.from_arrays([pa.array(task, pa.int32()), pa.array([rec[i:j].tobytes() for i, j in zip(cut, end)], pa.binary())], names=["task", "records"])

    return run


def on_both_sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes whose first words stand on both sides, from the records of a task: (seq, positions)."""
    r = np.frombuffer(b"".join(x for b in batches for x in b.column("records").to_pylist()), RECORD)
    if not r.size:
        return
    r = r[np.argsort(r["key"])]
    first = np.flatnonzero(np.concatenate(([True], r["key"][1:] != r["key"][:-1])))
    both = np.minimum.reduceat(r["side"], first) != np.maximum.reduceat(r["side"], first)
    r = r[np.repeat(both, np.diff(np.append(first, r.size)))]
    if not r.size:
        return
    r = r[np.argsort(r["seq"], kind="stable")]
    cut = np.flatnonzero(np.concatenate(([True], r["seq"][1:] != r["seq"][:-1])))
    at = pa.ListArray.from_arrays(pa.array(np.append(cut, r.size).astype(np.int32)), pa.array(r["at"].astype(np.int32)))
    yield pa.RecordBatch.from_arrays([pa.array(r["seq"][cut]), at], names=["seq", "at"])


def stretches(hot: np.ndarray):
    """(turn_id, side, seq, words, at) to a row per stretch of consecutive marked suffixes; ``hot`` are keys of both sides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, starts, sizes = W.flat_words(b)
            lists = b.column("at")
            n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            mark = np.zeros(flat.size + 1, bool)
            mark[np.repeat(starts, n) + lists.flatten().to_numpy(zero_copy_only=False)] = True
            if hot.size:
                key, row, at = heads(flat, starts, sizes)
                own = _within(key, hot)
                mark[starts[row[own]] + at[own]] = True
            # the last words of a text begin no suffix, so a stretch never goes on in the next one
            step = np.diff(np.concatenate(([0], mark.astype(np.int8))))
            lo, hi = np.flatnonzero(step == 1), np.flatnonzero(step == -1) + SHINGLE - 1
            if not lo.size:
                continue
            row = np.searchsorted(starts, lo, side="right") - 1
            size = hi - lo
            own = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
            ext = [xxhash.xxh3_64_intdigest(flat[i:j].tobytes()) for i, j in zip(lo, hi)]
            words = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(flat[own].view(np.int64)))
            cols = [b.column(c).take(pa.array(row)) for c in ("turn_id", "side", "seq")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array((lo - starts[row]).astype(np.int32)), pa.array(np.array(ext, np.uint64).view(np.int64)), words], names=["turn_id", "side", "seq", "start", "ext", "words"])

    return run


STRETCHES = "turn_id bigint, side int, seq bigint, start int, ext bigint, words array<bigint>"


def suffix_tails(tasks: int):
    """Suffixes of the stretches with their words up to ``DEPTH``: (task, records, words after the first ``SHINGLE``, big-endian)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, starts, sizes = W.flat_words(b)
            key, row, at = heads(flat, starts, sizes)
            rec = np.empty(key.size, TAIL)
            rec["key"], rec["at"] = key, at
            rec["n"] = np.minimum(sizes[row] - at, DEPTH) - SHINGLE
            for c in ("ext", "tr", "ev"):
                rec[c] = b.column(c).to_numpy(zero_copy_only=False)[row]
            o, cut, end, task = _sent(((key >> np.uint64(32)) % np.uint64(tasks)).astype(np.int32), rec)
            rec, begin = rec[o], (starts[row] + at + SHINGLE)[o]
            big = flat.astype(">u8")
            tails = []
            for i, j in zip(cut, end):
                n = rec["n"][i:j].astype(np.int64)
                tails.append(big[np.repeat(begin[i:j] - (np.cumsum(n) - n), n) + np.arange(n.sum())].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(task, pa.int32()), pa.array([rec[i:j].tobytes() for i, j in zip(cut, end)], pa.binary()), pa.array(tails, pa.binary())], names=["task", "records", "tails"])

    return run


def neighbours(common: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the next training one before it in the order, or -1, and the length of their common prefix; ``common`` is that of each suffix and the one before."""
    who, length = np.full(train.size, -1), np.zeros(train.size, np.int64)
    last, least = -1, 0
    for i, (c, t) in enumerate(zip(common.tolist(), train.tolist())):
        least = min(least, c)
        if least >= SHINGLE:
            who[i], length[i] = last, least
        if t:
            last, least = i, DEPTH
    return who, length


def adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort the suffixes of a task and read what each evaluation suffix shares with the training suffixes next to it: (ext, at, len, other)."""
    recs, tails = [], []
    for b in batches:
        recs += b.column("records").to_pylist()
        tails += b.column("tails").to_pylist()
    r, t = np.frombuffer(b"".join(recs), TAIL), b"".join(tails)
    del recs, tails
    if not r.size:
        return
    end = np.cumsum(r["n"], dtype=np.int64)
    begin = end - r["n"]
    heading = r["key"].astype(">u8").tobytes()
    whole = [heading[8 * i : 8 * i + 8] + t[8 * x : 8 * y] for i, (x, y) in enumerate(zip(begin.tolist(), end.tolist()))]
    order = np.array(sorted(range(r.size), key=whole.__getitem__))
    del whole
    r, begin, n = r[order], begin[order], r["n"][order].astype(np.int64)
    letters = np.frombuffer(t, ">u8")
    common = np.zeros(r.size, np.int64)
    i = np.flatnonzero(r["key"][1:] == r["key"][:-1]) + 1
    d = 0
    while i.size:
        common[i] = SHINGLE + d
        i = i[(n[i] > d) & (n[i - 1] > d)]
        i = i[letters[begin[i] + d] == letters[begin[i - 1] + d]]
        d += 1
    out = []

    def add(who, other, length):
        out.append((r["ext"][who], r["at"][who], length, r["ext"][other]))

    ev = np.flatnonzero(r["ev"])
    own = ev[r["tr"][ev]]
    add(own, own, SHINGLE + n[own])
    before, length = neighbours(common, r["tr"])
    own = ev[before[ev] >= 0]
    add(own, before[own], length[own])
    after, length = neighbours(np.append(0, common[:0:-1]), r["tr"][::-1])
    after, length = np.where(after >= 0, r.size - 1 - after, -1)[::-1], length[::-1]
    own = ev[after[ev] >= 0]
    add(own, after[own], length[own])
    ext, at, length, other = (np.concatenate(x) for x in zip(*out))
    yield pa.RecordBatch.from_arrays([pa.array(ext), pa.array(at.astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(other)], names=["ext", "at", "len", "other"])


def merged(spans: Column) -> Column:
    """Spans (lo, hi) in an array, those that touch or overlap made one."""
    return F.aggregate(
        F.array_sort(spans),
        F.expr("cast(array() as array<struct<lo:int,hi:int>>)"),
        lambda out, x: F.when(
            (F.size(out) > 0) & (F.element_at(out, F.greatest(F.size(out), F.lit(1)))["hi"] >= x["lo"]),
            F.concat(
                F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))),
                F.array(F.struct(F.element_at(out, -1)["lo"].alias("lo"), F.greatest(F.element_at(out, -1)["hi"], x["hi"]).alias("hi"))),
            ),
        ).otherwise(F.concat(out, F.array(x))),
    )


class Suffixes:
    """What the suffixes of the evaluation texts (side 1) share with those of the training texts (side 0) of ``turns`` (turn_id, text, side).

    ``pairs`` is (eval_turn, train_turn): for every evaluation text a training text next
    to one of its suffixes; with ``cover``, ``covered`` is (turn_id, n_words, covered_words)
    of every evaluation turn with ``MIN_WORDS`` distinct words.
    """

    def __init__(self, turns: DataFrame, cover: bool):
        self.spark = turns.sparkSession
        t = turns.where("turn_id is not null").select("turn_id", "text", "side")
        seqs = Stage(t.mapInArrow(sequences, SEQUENCES), "sequences")
        given = seqs.df.where("words is not null")
        hot, shared = self._hot(given)
        marks = self._marks(given, hot)
        at = reduce(DataFrame.unionByName, [m.df for m in marks]).groupBy("seq").agg(F.flatten(F.collect_list("at")).alias("at"))
        at = Stage(at, "marks")
        for m in marks:
            m.drop()
        cells = at.df.agg(F.sum(4 + F.size("at"))).head()[0] or 0
        found = given.join(small(at.df, cells // 4), "seq", "left" if shared.size else "inner")
        rows = Stage(found.select("turn_id", "side", "seq", "words", "at").mapInArrow(stretches(shared), STRETCHES), "stretches")
        at.drop()
        side = lambda s: F.min(F.when(F.col("side") == s, F.col("turn_id")))
        once = rows.df.groupBy("ext").agg(side(0).alias("train_turn"), side(1).alias("some"), F.first("words").alias("words"))
        once = Stage(once, "stretch")
        spans = self._spans(once.df)
        own = rows.df.where("side = 1")
        self.pairs = Stage(self._pairs(own, once.df, spans.df), "suffix_pairs")
        self.covered = Stage(self._covered(seqs.df, own, spans.df), "covered") if cover else None
        for s in (seqs, rows, once, spans):
            s.drop()

    def _tasks(self, n: int | None, each: int) -> int:
        return max(self.spark.sparkContext.defaultParallelism, -(-(n or 0) // each))

    def _hot(self, given: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Keys of many suffixes, and those of them that stand on both sides."""
        n = given.count()
        some = given.where(F.pmod("seq", F.lit(SAMPLE)) == 0).select("words").mapInArrow(counted, "key bigint, n bigint")
        some = some.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= max(HOT, n // SHARE) / SAMPLE)
        hot = np.sort(np.array([r["key"] for r in some.select("key").collect()], np.int64).view(np.uint64))
        if not hot.size:
            return hot, hot
        sides = given.select("side", "words").mapInArrow(sides_of(hot), "key bigint, side int").distinct().collect()
        both = {r["key"] for r in sides if r["side"]} & {r["key"] for r in sides if not r["side"]}
        return hot, np.sort(np.array(sorted(both), np.int64).view(np.uint64))

    def _marks(self, given: DataFrame, hot: np.ndarray) -> list[Stage]:
        n = given.agg(F.sum(F.col("n") - (SHINGLE - 1))).head()[0]
        tasks = self._tasks(n, PARTS * RECORDS_PER_TASK)
        out = []
        for part in range(PARTS):
            sent = given.select("seq", "side", "words").mapInArrow(suffix_heads(part, PARTS, tasks, hot), "task int, records binary")
            out.append(Stage(sent.repartitionById(tasks, "task").mapInArrow(on_both_sides, "seq bigint, at array<int>"), "marked"))
        return out

    def _spans(self, once: DataFrame) -> Stage:
        n = once.agg(F.sum(F.size("words") - (SHINGLE - 1))).head()[0]
        tasks = self._tasks(n, TAILS_PER_TASK)
        rows = once.select("ext", F.col("train_turn").isNotNull().alias("tr"), F.col("some").isNotNull().alias("ev"), "words")
        sent = rows.mapInArrow(suffix_tails(tasks), "task int, records binary, tails binary")
        return Stage(sent.repartitionById(tasks, "task").mapInArrow(adjacent, "ext bigint, at int, len int, other bigint"), "spans")

    def _pairs(self, own: DataFrame, once: DataFrame, spans: DataFrame) -> DataFrame:
        next_to = spans.select("ext", "other").distinct().join(once.where("train_turn is not null").select(F.col("ext").alias("other"), "train_turn"), "other")
        next_to = Stage(next_to.select("ext", "train_turn").distinct(), "next_to")
        near = own.select(F.col("turn_id").alias("eval_turn"), "ext").distinct().join(small(next_to.df, next_to.df.count()), "ext")
        return near.select("eval_turn", "train_turn").distinct()

    def _covered(self, seqs: DataFrame, own: DataFrame, spans: DataFrame) -> DataFrame:
        span = lambda lo, hi: F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
        runs = Stage(spans.groupBy("ext").agg(merged(F.collect_set(span(F.col("at"), F.col("at") + F.col("len")))).alias("runs")), "runs")
        every = own.select("seq", "start", "ext").distinct().join(small(runs.df, 4 * runs.df.count()), "ext")
        moved = F.transform("runs", lambda x: span(x["lo"] + F.col("start"), x["hi"] + F.col("start")))
        words = every.groupBy("seq").agg(merged(F.flatten(F.collect_list(moved))).alias("runs"))
        words = words.select("seq", F.aggregate("runs", F.lit(0), lambda s, x: s + x["hi"] - x["lo"]).alias("covered_words"))
        turn = seqs.where("side = 1").select("turn_id", "seq", F.col("n").alias("n_words")).distinct()
        return turn.join(words, "seq", "left").select("turn_id", "n_words", F.coalesce("covered_words", F.lit(0)).alias("covered_words"))
