"""Near texts by shared bands of minhashes: one candidate search for problems 3 and 5.

1. One pass over all texts gives each its class, and each class its signature and
   distinct words (``words.sketch``); copies are one class.
2. Every class sends a record of 31 bytes for each of its bands to the task the
   band's hash names.  Records travel packed, an array per batch and task, so the
   shuffle handles few large rows.  Bands are taken some at a time, and the shuffle
   files of each pass are removed after it.
3. A task sorts its records by key; the blocks of equal keys go through the binary
   trie join of their signatures, all at once.
4. Candidates are checked exactly on their distinct words.

A key under which more than one class in two hundred falls is hot.  Such keys are
counted first, batch by batch (there are at most 400 for a band).  For problem 5
the classes under a hot key are linked to one of them, linear in their number, and
a key whose classes are linked among themselves then is left out.  What remains is
cut into chunks, each pair of chunks a block of its own.

For problem 5 the first bands are taken twice.  The first time a block of more than
``STAR`` classes gives only the pairs of a few centres with what is near them; what
these and the short blocks link is one component from then on, and the passes that
follow look for pairs of different components only, in all bands and blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import words as W
from threadloom.llm.trie import trie_join
from threadloom.operators.graph import connected_components
from threadloom.session import Stage

JACCARD = 0.7
#: Differing bits allowed of 128: at Jaccard 0.7 the mean is 19.2 and the deviation 4.0, so one pair in 10,000 exceeds it.
BUDGET = 36
#: Classes of a block from which on it is linked to centres first, and how many centres it has at most.
STAR, CENTRES = 64, 16
#: A key with fewer classes is never hot.
HOT = 4096
#: A hot key holds at least one class in so many.
SHARE = 200
#: Rows of a chunk of a hot key.
CHUNK = 65_536
BANDS_PER_PASS = 18
RECORDS_PER_TASK = 500_000
#: A side of ids up to this many rows (16 bytes each) is broadcast; a longer one is joined by shuffle.
BROADCAST_ROWS = 1_000_000

RECORD = np.dtype([("key", "<u4"), ("cls", "<i8"), ("s0", "<i8"), ("s1", "<i8"), ("n", "<u2"), ("flag", "u1")])
#: The same with the component of the class, where some classes are linked already.
LINKED = np.dtype([*RECORD.descr, ("comp", "<i8")])
TR, EV, PART, SECOND = 1, 2, 4, 8


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a side whose counted rows are within the bound, else a hash join by shuffle, which spares sorting the large side."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df.hint("shuffle_hash")


def flagged(rows: int, bands: int):
    """Keys that more than one class in ``2 * SHARE`` of a batch holds: (key, n, tr, ev)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keys = W.band_keys(*W.flat_words(b), rows, 0, bands)
            tr, ev = (b.column(c).to_numpy().astype(bool) for c in ("tr", "ev"))
            out = []
            for k in keys:
                u, at, n = np.unique(k, return_inverse=True, return_counts=True)
                many = np.flatnonzero(n >= max(2, b.num_rows // (2 * SHARE)))
                if many.size:
                    side = [np.bincount(at, x, u.size)[many] > 0 for x in (tr, ev)]
                    out.append((u[many].view(np.int64), n[many], *side))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["key", "n", "tr", "ev"])

    return run


def under_hot(rows: int, bands: int, hot: np.ndarray, value: str, what: str):
    """Of the classes under the hot keys: least and greatest ``value`` per key and batch (``ends``), or links to the keys' centres (``links``; ``value`` is a map then)."""
    order = np.argsort(hot)

    def found(keys: np.ndarray):
        at = np.minimum(np.searchsorted(hot, keys, sorter=order), hot.size - 1)
        return order[at], hot[order[at]] == keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            at, hit = found(W.band_keys(*W.flat_words(b), rows, 0, bands))
            at, col = at[hit], np.nonzero(hit)[1]
            if not at.size:
                continue
            if what == "ends":
                v = b.column(value).to_numpy()[col]
                o = np.argsort(at, kind="stable")
                first = np.flatnonzero(np.concatenate(([True], at[o][1:] != at[o][:-1])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hot[at[o][first]].view(np.int64)), pa.array(np.minimum.reduceat(v[o], first)), pa.array(np.maximum.reduceat(v[o], first))], names=["key", "lo", "hi"]
                )
            else:
                cls = b.column("cls").to_numpy()
                p = np.unique(np.stack((value[at], cls[col]), 1), axis=0)
                p = p[p[:, 0] != p[:, 1]]
                if p.size:
                    yield pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], names=["a", "b"])

    return run


def packed(rows: int, first: int, last: int, tasks: int, hot: np.ndarray, chunks: np.ndarray, linked: bool):
    """Records of the classes under their bands: (task, records as bytes).

    ``chunks`` says into how many chunks a hot key is cut; one of 0 is left out.
    """
    order = np.argsort(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            flat, starts, sizes = W.flat_words(b)
            keys = W.band_keys(flat, starts, sizes, rows, first, last)
            col = np.tile(np.arange(b.num_rows), last - first)
            keys = keys.ravel()
            flag = (b.column("tr").to_numpy() * TR + b.column("ev").to_numpy() * EV).astype(np.uint8)[col]
            if hot.size:
                at = order[np.minimum(np.searchsorted(hot, keys, sorter=order), hot.size - 1)]
                c = np.where(hot[at] == keys, chunks[at], 1)
                cls = b.column("cls").to_numpy()
                parts = [(keys[c == 1], col[c == 1], flag[c == 1])]
                for i in np.flatnonzero(c > 1):
                    own, other = int(cls[col[i]] % c[i]), np.arange(c[i])
                    lo, hi = np.minimum(own, other).astype(np.uint64), np.maximum(own, other).astype(np.uint64)
                    half = np.where(lo == hi, 0, PART + np.where(lo == own, 0, SECOND)).astype(np.uint8)
                    parts.append((W.mix(W.mix(keys[i] ^ lo, W.M1) ^ hi, W.M2), np.full(c[i], col[i]), flag[i] | half))
                keys, col, flag = (np.concatenate(x) for x in zip(*parts))
            rec = np.empty(keys.size, LINKED if linked else RECORD)
            rec["key"] = keys & np.uint64(0xFFFFFFFF)
            for c in ("cls", "s0", "s1", *(["comp"] if linked else [])):
                rec[c] = b.column(c).to_numpy()[col]
            rec["n"], rec["flag"] = np.minimum(sizes, 65_535)[col], flag
            to = ((keys >> np.uint64(32)) % np.uint64(tasks)).astype(np.int32)
            o = np.argsort(to, kind="stable")
            rec, to = rec[o], to[o]
            cut = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1]))) if to.size else np.empty(0, np.int64)
            ends = np.append(cut[1:], to.size)
            yield pa.RecordBatch.from_arrays([pa.array(to[cut]), pa.array([rec[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary())], names=["task", "records"])

    return run


def centre_pairs(key: np.ndarray, cls: np.ndarray, s0: np.ndarray, s1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one block: the class of least hash with all within the budget, then the same among the others, until few or ``CENTRES`` are done."""
    left = np.arange(cls.size)
    order = W.mix(cls.view(np.uint64) ^ key.astype(np.uint64), W.M2)
    out = []
    for _ in range(CENTRES):
        if left.size < 2:
            break
        c = left[order[left].argmin()]
        near = np.bitwise_count(s0[left] ^ s0[c]).astype(np.int32) + np.bitwise_count(s1[left] ^ s1[c]) <= BUDGET
        own = left[near & (left != c)]
        out.append(np.stack((np.full(own.size, c), own)))
        left = left[~near]
    i, j = np.concatenate(out, 1) if out else np.empty((2, 0), np.int64)
    return i, j


def block_pairs(linked: bool, cross: bool, centres: bool = False):
    """Candidate pairs (a, b), a < b, of classes from the records of a task.

    Of different components (``linked``), of both sides (``cross``); with ``centres``
    blocks of more than ``STAR`` give their ``centre_pairs`` only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [x for b in batches for x in b.column("records").to_pylist()]
        r = np.frombuffer(b"".join(got), LINKED if linked else RECORD)
        del got
        r = r[np.argsort(r["key"])]
        k = r["key"]
        twin = np.concatenate((k[1:] == k[:-1], [False])) if k.size else np.empty(0, bool)
        r = r[twin | np.concatenate(([False], twin[:-1]))] if k.size else r
        out = []
        for part in (False, True):
            own = r[(r["flag"] & PART > 0) == part]
            if not own.size:
                continue
            if centres and not part:
                edge = np.flatnonzero(np.concatenate(([True], own["key"][1:] != own["key"][:-1])))
                size = np.diff(np.append(edge, own.size))
                for a, z in zip(edge[size > STAR], size[size > STAR]):
                    b = own[a : a + z]
                    c = np.ascontiguousarray(b["cls"])
                    i, j = centre_pairs(b["key"], c, np.ascontiguousarray(b["s0"]).view(np.uint64), np.ascontiguousarray(b["s1"]).view(np.uint64))
                    out.append(np.stack(_unique_pairs(c[i], c[j]), 1))
                own = own[np.repeat(size <= STAR, size)]
            flag, n, cls = own["flag"], own["n"].astype(np.int64), np.ascontiguousarray(own["cls"])
            side = (flag & SECOND > 0).astype(np.int8) if part else None
            both = (flag & TR > 0, flag & EV > 0) if cross else (None, None)
            comp = np.ascontiguousarray(own["comp"]) if linked else None
            for i, j in trie_join(np.ascontiguousarray(own["key"]), np.ascontiguousarray(own["s0"]), np.ascontiguousarray(own["s1"]), BUDGET, side, comp, *both):
                ok = (np.minimum(n[i], n[j]) >= JACCARD * np.maximum(n[i], n[j]) - 1e-9) | (np.maximum(n[i], n[j]) == 65_535)
                out.append(np.stack(_unique_pairs(cls[i[ok]], cls[j[ok]]), 1))
        if out:
            p = np.unique(np.concatenate(out), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], names=["a", "b"])

    return run


def _unique_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    p = np.unique(np.stack((lo, hi), 1)[lo != hi], axis=0)
    return p[:, 0], p[:, 1]


class Banded:
    """Classes of the texts, and the pairs of classes that are near, whatever the order of their words.

    ``turns`` has (turn_id, text, side).  A class is ``tr`` if it holds a text of side
    0 and ``ev`` if one of side 1, or both where sides are null.  With ``cross`` only
    pairs with one of each are looked for.
    """

    def __init__(self, turns: DataFrame, cross: bool):
        self.cross, self.linked = cross, False
        self.spark = turns.sparkSession
        self.sketch = Stage(turns.where("turn_id is not null").select("turn_id", "text", "side").mapInArrow(W.sketch, W.SKETCH), "sketch")
        self.member = self.sketch.df.select("turn_id", "side", "cls").distinct()
        flag = lambda c: F.coalesce(c.cast("int"), F.lit(1))
        rep = self.sketch.df.groupBy("cls").agg(F.min(F.when(F.col("s0").isNotNull(), F.col("turn_id"))).alias("turn_id"), flag(F.min("side") == 0).alias("tr"), flag(F.max("side") == 1).alias("ev"))
        self.reps = Stage(rep, "reps")
        self.n = self.reps.df.count()
        both = self.sketch.df.where("s0 is not null").select("turn_id", "cls", "s0", "s1", "words").join(small(self.reps.df, self.n), ["turn_id", "cls"])
        self.features = Stage(both.select("cls", "s0", "s1", "tr", "ev", "words").dropDuplicates(["cls"]) if self._repeated() else both.select("cls", "s0", "s1", "tr", "ev", "words"), "features")
        self.rows, self.bands = W.band_plan(self.n, JACCARD)

    def _repeated(self) -> bool:
        """Whether a turn stands in the table twice, so that a class could come from both."""
        return bool(self.sketch.df.where("s0 is not null").groupBy("turn_id", "cls").count().where("count > 1").head(1))

    def _hot(self) -> dict[int, int]:
        """Rows seen under each hot key, at most ``2 * SHARE`` keys a band."""
        found = self.features.df.select("tr", "ev", "words").mapInArrow(flagged(self.rows, self.bands), "key bigint, n bigint, tr boolean, ev boolean")
        keys = found.groupBy("key").agg(F.sum("n").alias("n"), F.max("tr").alias("tr"), F.max("ev").alias("ev"))
        keys = keys.where(F.col("n") >= max(HOT, self.n // (2 * SHARE)))
        return {r["key"]: r["n"] for r in keys.select("key", "n").collect()}

    def _ends(self, df: DataFrame, hot: np.ndarray, value: str) -> dict[int, tuple[int, int]]:
        got = df.select(value, "words").mapInArrow(under_hot(self.rows, self.bands, hot, value, "ends"), "key bigint, lo bigint, hi bigint")
        return {r["key"]: (r["lo"], r["hi"]) for r in got.groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()}

    def near(self, more: DataFrame | None = None) -> DataFrame:
        """Pairs (a, b, jaccard), a < b, of near classes; without ``cross`` enough of them to link every two classes that near ones chain together.

        ``more`` has candidates (a, b), a < b, found otherwise, which are checked with the others.
        """
        seen = self._hot()
        keys = np.array(sorted(seen), np.int64)
        hot, chunks = keys.view(np.uint64), np.array([-(-seen[k] // CHUNK) for k in keys.tolist()], np.int64)
        edges: list[DataFrame] = []
        if keys.size and not self.cross:
            low = self._ends(self.features.df, hot, "cls")
            centre = np.array([low[k][0] for k in keys.tolist()], np.int64)
            pairs = self.features.df.select("cls", "words").mapInArrow(under_hot(self.rows, self.bands, hot, centre, "links"), "a bigint, b bigint")
            edges.append(self.verified(pairs.distinct()))
            chunks = self._link(edges, keys, chunks)
        if not self.cross:
            first = self._pass(0, min(BANDS_PER_PASS, self.bands), hot, chunks, centres=True)
            edges.append(self.verified(first.df))
            first.drop()
            chunks = self._link(edges, keys, chunks)
        passes = [self._pass(at, min(at + BANDS_PER_PASS, self.bands), hot, chunks) for at in range(0, self.bands, BANDS_PER_PASS)]
        found = [p.df for p in passes] + ([] if more is None else [more])
        every = reduce(DataFrame.unionByName, found).distinct() if len(found) > 1 else found[0]
        edges.append(self.verified(every))
        for p in passes:
            p.drop()
        return reduce(DataFrame.unionByName, edges)

    def _link(self, edges: list[DataFrame], keys: np.ndarray, chunks: np.ndarray) -> np.ndarray:
        """Give every class the component that the edges so far put it in; hot keys of one component get no chunks."""
        comp = connected_components(reduce(DataFrame.unionByName, edges), "a", "b").select(F.col("node").alias("cls"), "component")
        comp = Stage(comp, "components")
        old = self.features
        feats = old.df.drop("comp").join(small(comp.df, comp.df.count()), "cls", "left").withColumn("comp", F.coalesce("component", "cls")).drop("component")
        self.features, self.linked = Stage(feats, "linked"), True
        old.drop()
        comp.drop()
        if not keys.size:
            return chunks
        ends = self._ends(self.features.df, keys.view(np.uint64), "comp")
        return np.where([ends[k][0] == ends[k][1] for k in keys.tolist()], 0, chunks)

    def _pass(self, first: int, last: int, hot: np.ndarray, chunks: np.ndarray, centres: bool = False) -> Stage:
        """Candidate pairs under some of the bands."""
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-self.n * (last - first) // RECORDS_PER_TASK))
        sent = self.features.df.mapInArrow(packed(self.rows, first, last, tasks, hot, chunks, self.linked), "task int, records binary")
        pairs = sent.repartitionById(tasks, "task").mapInArrow(block_pairs(self.linked, self.cross, centres), "a bigint, b bigint")
        return Stage(pairs.distinct(), "candidates")

    def verified(self, pairs: DataFrame, least: float = JACCARD) -> DataFrame:
        """Pairs (a, b, jaccard) of classes whose distinct words have at least that Jaccard similarity."""
        pairs = Stage(pairs, "pairs")
        ids = pairs.df.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        ids = Stage(ids, "ids")
        w = self.features.df.select("cls", "words").join(small(ids.df, ids.df.count()), "cls", "left_semi")
        p = pairs.df.join(w.select(F.col("cls").alias("a"), F.col("words").alias("wa")), "a").join(w.select(F.col("cls").alias("b"), F.col("words").alias("wb")), "b")
        p = p.withColumn("common", F.size(F.array_intersect("wa", "wb"))).withColumn("n_union", F.size("wa") + F.size("wb") - F.col("common"))
        p = p.where(F.col("common") >= F.col("n_union") * F.lit(least) - 1e-9).select("a", "b", (F.col("common") / F.col("n_union")).alias("jaccard"))
        out = Stage(p, "verified")
        for s in (pairs, ids):
            s.drop()
        return out.df

    def drop(self) -> None:
        """Remove what only the search needed; the sketch, with every text's class, stays."""
        for s in (self.reps, self.features):
            s.drop()
