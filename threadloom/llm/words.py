"""Word features of texts, computed in Arrow batches with numpy.

A *word* is a longest run of Unicode letters and digits of the lower-cased text.
Every word has a 64-bit hash; a *class* is the set of distinct words of a text,
named by a 64-bit sum of mixed word hashes, so texts with equal word sets (exact
copies first of all) fall into one class.  A *band* is a hash of some minhashes of
the set: two sets of Jaccard s share it with probability s to the power of their
number, in whatever order the words stand.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORD = re.compile(r"[^\W_]+")
MIN_WORDS = 24
SIG_BITS = 128
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
#: Chance that two sets at the threshold of similarity share no band.
MISS = 5e-5
#: Words of one block of texts whose minhashes are taken together; it stays in the processor's cache.
CELLS = 1 << 17
#: Classes that a task remembers to have given the words of.
SEEN = 1_000_000


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class Hasher(dict):
    """Word to 64-bit hash; forgets when it holds too many words."""

    limit = 1_000_000

    def __missing__(self, w: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


def mix(x: np.ndarray, m: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * m
    return x ^ (x >> np.uint64(32))


def class_ids(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One id per text from its distinct word hashes, whatever their order."""
    return mix(np.add.reduceat(mix(flat, M1), starts), M3).view(np.int64)


def band_plan(classes: int, jaccard: float) -> tuple[int, int]:
    """(minhashes of a band, bands) for so many classes.

    Unlike sets share a band the less, the more minhashes it has; one is added for
    every 25-fold number beyond four million, so blocks stay short.  The number of
    bands follows so that a pair at the threshold is missed with probability
    ``MISS``, whatever the size.
    """
    rows = 5 + max(0, math.ceil(math.log(max(classes, 1) / 4e6, 25)))
    return rows, math.ceil(math.log(MISS) / math.log(1 - jaccard**rows))


def _odd(name: str, i: int) -> np.uint32:
    return np.uint32(xxhash.xxh3_64_intdigest(f"{name}{i}") & 0xFFFFFFFF | 1)


def minhashes(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, name: str, first: int, last: int) -> np.ndarray:
    """(hash, text) 32-bit minima of the hashes ``first`` to ``last`` of the family ``name``.

    Texts of like size are laid side by side, a word per row and the last word
    repeated in shorter ones, so a minimum is taken over whole rows at once.
    """
    h = (mix(flat, M3) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((last - first, starts.size), np.uint32)
    factors = [_odd(name, i) for i in range(first, last)]
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < order.size:
        # as many texts as fit if each had the size of the last one
        room = np.flatnonzero(sizes[order[at:]] * np.arange(1, order.size - at + 1) > CELLS)
        end = at + max(1, int(room[0]) if room.size else order.size - at)
        own = order[at:end]
        long = int(sizes[own[-1]])
        m = np.ascontiguousarray(h[starts[own] + np.minimum(np.arange(long)[:, None], sizes[own] - 1)])
        buf = np.empty_like(m)
        low = np.empty((len(factors), own.size), np.uint32)
        for i, f in enumerate(factors):
            np.multiply(m, f, out=buf)
            np.min(buf, axis=0, out=low[i])
        out[:, own] = low
        at = end
    return out


def signatures(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 one-bit minhashes per text as two words of 64 bits: two sets differ in a bit with probability (1 - Jaccard) / 2."""
    low = minhashes(flat, starts, sizes, "s", 0, SIG_BITS).astype(np.uint64)
    bits = (mix(low, M1) >> np.uint64(17)) & np.uint64(1)
    out = [np.zeros(starts.size, np.uint64), np.zeros(starts.size, np.uint64)]
    for i in range(SIG_BITS):
        out[i // 64] |= bits[i] << np.uint64(63 - i % 64)
    return out[0], out[1]


def band_keys(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: int, first: int, last: int) -> np.ndarray:
    """(band, text) hash of ``rows`` minhashes each."""
    low = minhashes(flat, starts, sizes, "b", first * rows, last * rows).reshape(last - first, rows, starts.size)
    k = np.repeat(np.arange(first + 1, last + 1, dtype=np.uint64)[:, None], starts.size, 1)
    for i in range(rows):
        k = mix(k * M2 + low[:, i].astype(np.uint64), M1)
    return k


def batch_words(texts: list[str | None], h: Hasher, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a batch with at least ``least`` distinct words: (rows, hashes of the distinct words, starts, sizes)."""
    rows, uniq, sizes = [], [], []
    for i, t in enumerate(texts):
        if not t:
            continue
        s = set(WORD.findall(t.lower()))
        if len(s) >= least:
            rows.append(i)
            sizes.append(len(s))
            uniq.extend([h[w] for w in s])
    sz = np.array(sizes, np.int64)
    return np.array(rows, np.int64), np.array(uniq, np.uint64), np.cumsum(sz) - sz, sz


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(turn_id, text, side) to (turn_id, side, cls, s0, s1, words); texts with few distinct words give no row.

    Signature and words come the first time a task meets a class, later copies have nulls.
    """
    h, seen = Hasher(), set()
    for b in batches:
        rows, uq, us, sz = batch_words(b.column("text").to_pylist(), h)
        if not rows.size:
            continue
        cls = class_ids(uq, us)
        new = np.zeros(rows.size, bool)
        for i, c in enumerate(cls.tolist()):
            if c not in seen:
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(c)
                new[i] = True
        keep = np.repeat(new, sz)
        n = sz[new]
        cols = [b.column(c).take(pa.array(rows)) for c in ("turn_id", "side")] + [pa.array(cls)]
        at = pa.array(np.where(new, np.cumsum(new) - 1, 0), mask=~new)
        if n.size:
            uq = uq[keep]
            starts = np.cumsum(n) - n
            cols += [pa.array(s.view(np.int64)).take(at) for s in signatures(uq, starts, n)]
            cols.append(pa.ListArray.from_arrays(pa.array(np.append(starts, uq.size).astype(np.int32)), pa.array(uq.view(np.int64))).take(at))
        else:
            cols += [pa.nulls(rows.size, t) for t in (pa.int64(), pa.int64(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(cols, names=["turn_id", "side", "cls", "s0", "s1", "words"])


SKETCH = "turn_id bigint, side int, cls bigint, s0 bigint, s1 bigint, words array<bigint>"


def flat_words(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, sizes) of the column ``words`` of a batch."""
    lists = b.column("words")
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.cumsum(sizes) - sizes, sizes
