"""Problem 10: the language of documents and of their stretches, by character models."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANGS = ("de", "en", "es", "fr", "it", "nl", "pt")
ORDER = 5
#: Labelled documents per language that the models are fitted on.
TRAIN_DOCS = 300
#: Consecutive words that make a stretch of prose; a text without ``ANY`` words of one language in a row has no prose.
STRETCH, ANY = 12, 5
#: Nats that a change of language costs: inside a clause, after a comma or other mark, at a line end, after a sentence, at a blank line.
SWITCH = np.array([16.0, 12.0, 10.0, 8.0, 7.0])
#: A word counts as no language from so many times the median cross-entropy of held-out prose on.
REJECT = 3.0
#: Score of a word with digits in any language against that in none.
DIGITS = -0.7
TOKEN = re.compile(r"([^\W_]+)((?:[\W_]+)?)")
M = np.uint64(0x9E3779B97F4A7C15)


def label(c: Column) -> Column:
    """The two letters a label names a language with, or ``und``; null if it names none."""
    part = F.lower(F.regexp_extract(c, r"^\s*([^-_\s]*)", 1))
    two = F.substring(part, 1, 2)
    return F.when(part == "und", "und").when(two.isin(*LANGS), two)


def _codes(ws: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of `` w `` for every word, one after the other: (codes, position in word, word)."""
    s = " ".join(ws)
    flat = np.frombuffer((" " + s + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    lens = np.fromiter((len(w) for w in ws), np.int64, len(ws)) + 2
    starts = np.cumsum(lens - 1) - (lens - 1)
    own = np.repeat(np.arange(len(ws)), lens)
    pos = np.arange(own.size) - np.repeat(np.cumsum(lens) - lens, lens)
    return flat[starts[own] + pos], pos, own


def _grams(codes: np.ndarray, pos: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that end at each character, and of their contexts; valid where pos >= n - 1."""
    h = np.full(codes.size, np.uint64(n), np.uint64)
    for i in range(n - 1, 0, -1):
        h[i:] = (h[i:] ^ codes[: codes.size - i]) * M
        h[i:] ^= h[i:] >> np.uint64(31)
    g = (h ^ codes) * M
    return g ^ (g >> np.uint64(29)), h


class KneserNey:
    """Interpolated Kneser-Ney models of all languages in sorted hash arrays.

    ``reject`` is the cross-entropy in nats a character from which a word is no
    language, ``sharp`` what differences of it are multiplied by in a confidence;
    both are set by ``calibrated``.
    """

    reject, sharp = 2.75, 10.0

    def __init__(self, counts: list[Counter]):
        k = len(counts)
        data = [(_codes(list(c)), np.array(list(c.values()), np.float64)) for c in counts]
        self.disc, self.bow = [None] * (ORDER + 1), [None] * (ORDER + 1)
        alphabet = max(2, len(np.unique(np.concatenate([d[0][0] for d in data]))))
        self.floor = 1.0 / alphabet
        for n in range(1, ORDER + 1):
            per = []
            for (codes, pos, own), weight in data:
                # below the highest order an n-gram counts once per character before it; at the start of a word by its tokens
                ok = pos >= max(n - 1, 1)
                g, h = _grams(codes, pos, n)
                g, h, w = g[ok], h[ok], weight[own[ok]]
                if n < ORDER:
                    wide, _ = _grams(codes, pos, n + 1)
                    has = (pos >= n)[ok]
                    key = np.where(has, wide[ok], g)
                    first = np.zeros(g.size, bool)
                    first[np.unique(key, return_index=True)[1]] = True
                    w = np.where(has, first.astype(np.float64), w)
                u, at = np.unique(g, return_index=True)
                total = np.zeros(u.size)
                np.add.at(total, np.searchsorted(u, g), w)
                total = np.maximum(total, 1e-9)
                uh, back = np.unique(h[at], return_inverse=True)
                n1, n2 = (np.abs(total - 1) < 0.5).sum(), (np.abs(total - 2) < 0.5).sum()
                d = min(0.95, max(0.1, n1 / max(1, n1 + 2 * n2)))
                sums, types = np.zeros(uh.size), np.zeros(uh.size)
                np.add.at(sums, back, total)
                np.add.at(types, back, np.minimum(1, total))
                per.append((u, np.maximum(total - d, 0) / sums[back], uh, np.minimum(1.0, d * types / sums)))
            keys = np.unique(np.concatenate([p[0] for p in per]))
            disc = np.zeros((keys.size, k), np.float32)
            ctx = np.unique(np.concatenate([p[2] for p in per]))
            bow = np.ones((ctx.size, k), np.float32)
            for i, (u, p, uh, b) in enumerate(per):
                disc[np.searchsorted(keys, u), i] = p
                bow[np.searchsorted(ctx, uh), i] = b
            self.disc[n], self.bow[n] = (keys, disc), (ctx, bow)

    @staticmethod
    def _look(table, h, default):
        keys, vals = table
        at = np.minimum(np.searchsorted(keys, h), keys.size - 1)
        out = vals[at]
        out[keys[at] != h] = default
        return out

    def scores(self, ws: list[str]) -> np.ndarray:
        """Log probability of every word in every language."""
        codes, pos, own = _codes(ws)
        p = np.full((codes.size, self.disc[1][1].shape[1]), self.floor, np.float32)
        for n in range(1, ORDER + 1):
            g, h = _grams(codes, pos, n)
            ok = pos >= max(n - 1, 1)
            p[ok] = self._look(self.disc[n], g[ok], 0.0) + self._look(self.bow[n], h[ok], 1.0) * p[ok]
        lp = np.log(np.maximum(p, 1e-9))
        lp[pos == 0] = 0
        out = np.zeros((len(ws), lp.shape[1]), np.float32)
        starts = np.flatnonzero(pos == 0)
        return np.add.reduceat(lp, starts, axis=0).astype(np.float32) if starts.size else out


class _Seps(dict):
    """What stands between two words to the kind of boundary it makes."""

    def __missing__(self, s: str) -> int:
        k = 4 if s.count("\n") > 1 else 3 if re.search(r"[.!?…]['\")\]]*\s", s) else 2 if "\n" in s else 1 if s.strip() else 0
        if len(self) < 200_000:
            self[s] = k
        return k


class Segmenter:
    """Words to languages: where a text is cut is found by Viterbi, changes costing ``SWITCH``; each stretch goes to the language of lowest length-normalised cross-entropy."""

    def __init__(self, model: KneserNey):
        self.model = model
        self.ids: dict[str, int] = {}
        self.table = np.zeros((0, len(LANGS) + 1), np.float32)
        self.chars = np.zeros(0, np.float32)
        self.seps = _Seps()

    def _learn(self, ws: set[str]) -> None:
        if len(self.ids) > 400_000:
            self.ids, self.table, self.chars = {}, self.table[:0], self.chars[:0]
        new = [w for w in ws if w not in self.ids]
        if not new:
            return
        n = np.array([len(w) + 1 for w in new], np.float32)
        s = np.empty((len(new), len(LANGS) + 1), np.float32)
        s[:, :-1] = self.model.scores(new)
        s[:, -1] = -self.model.reject * n
        odd = np.array([any(c.isdigit() for c in w) for w in new])
        s[odd, :-1], s[odd, -1] = DIGITS, 0.0
        base = len(self.ids)
        for i, w in enumerate(new):
            self.ids[w] = base + i
        self.table = np.concatenate((self.table, s))
        self.chars = np.concatenate((self.chars, n))

    def __call__(self, texts: list[str]) -> list[list[tuple[int, int, int, float]]]:
        """Per text its stretches (language or len(LANGS) for none, first word, end, confidence)."""
        toks = [TOKEN.findall(t.lower()) for t in texts]
        if len(self.ids) > 400_000:
            self._learn(set())
        self._learn({w for tk in toks for w, _ in tk})
        ids, seps = self.ids, self.seps
        rows = [np.fromiter((ids[w] for w, _ in tk), np.int64, len(tk)) for tk in toks]
        cost = [SWITCH[np.fromiter((seps[s] for _, s in tk), np.int64, len(tk))] for tk in toks]
        out: list[list] = [[] for _ in texts]
        order = sorted((i for i in range(len(texts)) if rows[i].size), key=lambda i: rows[i].size)
        at = 0
        while at < len(order):
            group = order[at : at + max(1, min(256, 400_000 // rows[order[min(at + 255, len(order) - 1)]].size))]
            at += len(group)
            self._decode(group, rows, cost, out)
        return out

    def _decode(self, group, rows, cost, out):
        k = len(LANGS) + 1
        n = np.array([rows[i].size for i in group])
        t_max = int(n.max())
        e = np.zeros((t_max, len(group), k), np.float32)
        c = np.full((t_max, len(group)), 99.0, np.float32)
        for j, i in enumerate(group):
            e[: n[j], j] = self.table[rows[i]]
            c[1 : n[j], j] = cost[i][:-1]
        stay = np.empty((t_max, len(group), k), bool)
        best_at = np.empty((t_max, len(group)), np.int8)
        v = e[0].copy()
        for t in range(1, t_max):
            b = v.argmax(1)
            best_at[t] = b
            alt = v[np.arange(v.shape[0]), b] - c[t]
            stay[t] = v >= alt[:, None]
            v = np.maximum(v, alt[:, None]) + e[t]
        state = np.full((t_max, len(group)), -1, np.int8)
        # past a text's end its words score nothing and changes cost too much to happen
        cur = v.argmax(1)
        for t in range(t_max - 1, -1, -1):
            state[t] = cur
            if t:
                cur = np.where(stay[t, np.arange(len(group)), cur], cur, best_at[t])
        for j, i in enumerate(group):
            s = state[: n[j], j]
            cut = np.flatnonzero(np.diff(s)) + 1
            sums = np.concatenate((np.zeros((1, k)), np.cumsum(e[: n[j], j], 0, dtype=np.float64)))
            chars = np.concatenate(([0.0], np.cumsum(self.chars[rows[i]], dtype=np.float64)))
            for a, b in zip(np.concatenate(([0], cut)), np.concatenate((cut, [n[j]]))):
                entropy = (sums[a] - sums[b]) / (chars[b] - chars[a])
                p = np.exp(-self.model.sharp * (entropy - entropy.min()))
                # within a stretch the lowest cross-entropy a character decides, unless it was rejected
                x = k - 1 if s[a] == k - 1 else int(entropy[:-1].argmin())
                out[i].append((x, int(a), int(b), round(float(p[x] / p.sum()), 4)))
            out[i] = _absorbed(out[i])


def _absorbed(cut: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """Headings and other pieces under ``ANY`` words go to the language on both sides of them, or before the first stretch to that."""
    out: list[tuple[int, int, int, float]] = []
    for x in cut:
        if out and out[-1][2] - out[-1][1] < ANY and x[2] - x[1] >= ANY and (len(out) == 1 or out[-2][0] == x[0]):
            low = out.pop()
            x = (x[0], low[1], x[2], x[3])
        if out and out[-1][0] == x[0]:
            last = out.pop()
            n, m = last[2] - last[1], x[2] - x[1]
            x = (x[0], last[1], x[2], round((last[3] * n + x[3] * m) / (n + m), 4))
        out.append(x)
    return out


def fit(documents: DataFrame, per_language: int = TRAIN_DOCS) -> KneserNey:
    """Models from at most ``per_language`` labelled documents of each language, taken in the order of a hash of the id.

    Labels may be wrong and texts mixed: a first model keeps those lines and
    sentences of the sample that it gives to their label, the second is fitted on them.
    """
    d = documents.select("doc_id", label(F.col("lang")).alias("l"), "text").where("text is not null")
    # a rank with a limit: each task keeps the first few of a label before anything is sent
    rank = F.row_number().over(Window.partitionBy("l").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = d.where(F.col("l").isin(*LANGS)).select("doc_id", "l").withColumn("r", rank).where(F.col("r") <= per_language)
    rows = d.join(F.broadcast(ids.select("doc_id").distinct()), "doc_id", "left_semi").where(F.col("l").isin(*LANGS)).select("doc_id", "l", "text").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["l"], r["text"]))
    units = [(i % 2, LANGS.index(r["l"]), [w for w in re.findall(r"[^\W\d_]+", u.lower())]) for i, r in enumerate(rows) for u in re.split(r"(?<=[.!?])\s+|\n", r["text"])]
    units = [u for u in units if u[2]]
    first = KneserNey(_counts((i, ws) for _, i, ws in units))
    vocab = sorted({w for _, _, ws in units for w in ws})
    if not vocab:
        return first
    score = dict(zip(vocab, first.scores(vocab)))
    own = KneserNey(_counts((i, ws) for _, i, ws in units if np.sum([score[w] for w in ws], 0).argmax() == i))
    half = KneserNey(_counts((i, ws) for k, i, ws in units if k == 0))
    own.reject, own.sharp = calibrated(half, [(i, ws) for k, i, ws in units if k == 1 and len(ws) >= ANY])
    return own


def _counts(units: Iterator[tuple[int, list[str]]]) -> list[Counter]:
    out = [Counter({"": 1}) for _ in LANGS]
    for i, ws in units:
        out[i].update(ws)
    return out


def calibrated(model: KneserNey, held_out: list[tuple[int, list[str]]]) -> tuple[float, float]:
    """(reject, sharp) from labelled sentences that the model was not fitted on.

    ``reject`` is ``REJECT`` times the median cross-entropy of those it gives to
    their label; ``sharp`` makes the mean confidence the share of them that it does.
    Without any the defaults stay.
    """
    if not held_out:
        return KneserNey.reject, KneserNey.sharp
    vocab = sorted({w for _, ws in held_out for w in ws})
    score = dict(zip(vocab, model.scores(vocab)))
    ce = np.array([-np.sum([score[w] for w in ws], 0) / sum(len(w) + 1 for w in ws) for _, ws in held_out])
    right = ce.argmin(1) == np.array([i for i, _ in held_out])
    if not right.any():
        return KneserNey.reject, KneserNey.sharp
    gap = ce - ce.min(1, keepdims=True)
    low, high = 0.1, 1000.0
    for _ in range(40):
        mid = math.sqrt(low * high)
        low, high = (mid, high) if (1 / np.exp(-mid * gap).sum(1)).mean() < right.mean() else (low, mid)
    return REJECT * float(np.median(ce.min(1)[right])), low


SCHEMA = "doc_id bigint, seq int, lang string, first_word int, n_words int, confidence double"


def stretches(documents: DataFrame, per_language: int = TRAIN_DOCS) -> DataFrame:
    """Every document cut into stretches of one language: ``(doc_id, seq, lang, first_word, n_words, confidence)``.

    ``lang`` is one of ``LANGS``, or ``und`` where the characters fit no language
    (logs, numbers, code).  Whole texts are read; texts that are null or have no
    word give one row with ``und``, no words and confidence 0.
    """
    spark = documents.sparkSession
    model = spark.sparkContext.broadcast(fit(documents, per_language))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = Segmenter(model.value)
        names = (*LANGS, "und")
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for s in range(0, len(ids), 2000):
                rows = []
                for d, cut in zip(ids[s : s + 2000], seg([t or "" for t in texts[s : s + 2000]])):
                    rows += [(d, q, names[x], a, e - a, c) for q, (x, a, e, c) in enumerate(cut)] or [(d, 0, "und", 0, 0, 0.0)]
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2]), pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int32()), pa.array(cols[5], pa.float64())],
                        names=["doc_id", "seq", "lang", "first_word", "n_words", "confidence"],
                    )

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def document_languages(documents: DataFrame, per_language: int = TRAIN_DOCS) -> DataFrame:
    """One row per document: label, languages with a stretch of at least 12 words, main language and confidence, mixed, label_right."""
    cut = stretches(documents, per_language).withColumn("prose", F.when(F.col("lang") != "und", F.col("n_words")).otherwise(0))
    d = cut.groupBy("doc_id").agg(
        F.sort_array(F.collect_set(F.when(F.col("prose") >= STRETCH, F.col("lang")))).alias("langs"),
        F.max("prose").alias("longest"),
        F.max(F.struct("prose", "confidence", "lang")).alias("top"),
    )
    main = F.when(F.col("longest") < ANY, "und").otherwise(F.col("top.lang"))
    d = d.select("doc_id", "langs", "longest", main.alias("main_lang"), F.col("top.confidence").alias("confidence"), (F.size("langs") > 1).alias("mixed"))
    lab = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", label(F.col("lang")).alias("named"))
    d = d.join(lab, "doc_id")
    right = F.coalesce((F.col("named") == F.col("main_lang")) | F.array_contains("langs", F.col("named")), F.lit(False))
    return d.withColumn("label_right", right).drop("named")


def wrong_labels(documents: DataFrame) -> DataFrame:
    """``(doc_id, found_lang)`` of documents with missing or wrong label or several languages: a row per language with a stretch, ``und`` without prose."""
    d = document_languages(documents).where("mixed or not label_right")
    found = F.when(F.col("main_lang") == "und", F.array(F.lit("und"))).otherwise(F.col("langs"))
    return d.select("doc_id", F.explode(found).alias("found_lang"))
