"""Linear-chain conditional random fields in numpy: fitted on a small labelled table, decoded in batches.

A position is described by a tuple of feature names.  Its score for each label
is the sum of the features' weights, so equal tuples are scored once and kept.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


class CRF:
    def __init__(self, labels: Sequence[str]):
        self.labels = list(labels)
        self.ids: dict[str, int] = {}
        self.w = self.trans = self.start = self.end = None

    def fit(self, seqs: list[list[tuple[str, ...]]], gold: list[list[str]], rounds: int = 140, rate: float = 0.12, l2: float = 2e-4, parts: int = 1) -> CRF:
        """Maximise the mean log likelihood by Adam; a round takes one of ``parts`` equal parts of the table in turn."""
        k = len(self.labels)
        for s in seqs:
            for feats in s:
                for f in feats:
                    self.ids.setdefault(f, len(self.ids))
        sets = [self._packed(seqs[i::parts], gold[i::parts]) for i in range(parts)]
        p = {"w": np.zeros((len(self.ids), k), np.float32), "t": np.zeros((k, k)), "s": np.zeros(k), "e": np.zeros(k)}
        m1, m2 = {a: np.zeros_like(b) for a, b in p.items()}, {a: np.zeros_like(b) for a, b in p.items()}
        for it in range(1, rounds + 1):
            n, g = self._gradient(p, *sets[it % parts])
            step = rate * min(1.0, 2 * (1 - it / (rounds + 1)))
            for x in p:
                grad = g[x] / n - l2 * p[x]
                m1[x] = 0.9 * m1[x] + 0.1 * grad
                m2[x] = 0.99 * m2[x] + 0.01 * grad**2
                p[x] += step * (m1[x] / (1 - 0.9**it)) / (np.sqrt(m2[x] / (1 - 0.99**it)) + 1e-8)
        self.w, self.trans, self.start, self.end = (p[x].astype(np.float32) for x in ("w", "t", "s", "e"))
        return self

    def _packed(self, seqs, gold):
        """Sequences padded to one length: features by cell and by feature, labels, mask."""
        of = {x: i for i, x in enumerate(self.labels)}
        n, t_max = len(seqs), max(map(len, seqs))
        flat, where = [], []
        for i, s in enumerate(seqs):
            for t, feats in enumerate(s):
                flat.extend([self.ids[f] for f in feats])
                where.extend([t * n + i] * len(feats))
        flat, where = np.array(flat), np.array(where)
        lens = np.array([len(s) for s in seqs])
        y = np.zeros((t_max, n), int)
        for i, g in enumerate(gold):
            y[: len(g), i] = [of[x] for x in g]
        order = np.argsort(where, kind="stable")
        ef, ew = flat[order], where[order]
        starts = np.flatnonzero(np.concatenate(([True], ew[1:] != ew[:-1])))
        by_f = np.argsort(flat, kind="stable")
        gf, gw = flat[by_f], where[by_f]
        g_starts = np.flatnonzero(np.concatenate(([True], gf[1:] != gf[:-1])))
        return n, t_max, lens, y, np.arange(t_max)[:, None] < lens, ef, starts, ew[starts], gw, g_starts, gf[g_starts]

    def _gradient(self, p, n, t_max, lens, y, mask, ef, starts, cells, gw, g_starts, g_ids):
        """Observed minus expected counts, by scaled forward and backward passes."""
        k = len(self.labels)
        em = np.zeros((t_max * n, k), np.float32)
        em[cells] = np.add.reduceat(p["w"][ef], starts, axis=0)
        em = em.reshape(t_max, n, k)
        e = np.exp(em - em.max(2, keepdims=True)).astype(np.float64)
        tr, first, final = np.exp(p["t"]), np.exp(p["s"] - p["s"].max()), np.exp(p["e"] - p["e"].max())
        a, b = np.empty_like(e), np.empty_like(e)
        a[0] = first * e[0]
        a[0] /= a[0].sum(1, keepdims=True)
        for t in range(1, t_max):
            step = (a[t - 1] @ tr) * e[t]
            a[t] = np.where(mask[t][:, None], step / step.sum(1, keepdims=True), a[t - 1])
        b[-1] = final
        for t in range(t_max - 2, -1, -1):
            step = (e[t + 1] * b[t + 1]) @ tr.T
            b[t] = np.where(mask[t + 1][:, None], step / step.sum(1, keepdims=True), final)
        post = a * b
        post *= mask[:, :, None] / post.sum(2, keepdims=True)
        g_em = -post
        g_em[np.arange(t_max)[:, None], np.arange(n)[None], y] += mask
        g = {"t": np.zeros((k, k)), "w": np.zeros_like(p["w"])}
        for t in range(1, t_max):
            live = mask[t]
            right = e[t][live] * b[t][live]
            left = a[t - 1][live]
            left = left / ((left @ tr) * right).sum(1, keepdims=True)
            g["t"] -= (left.T @ right) * tr
            np.add.at(g["t"], (y[t - 1][live], y[t][live]), 1)
        last, rows = lens - 1, np.arange(n)
        g["s"] = np.bincount(y[0], minlength=k) - post[0].sum(0)
        g["e"] = np.bincount(y[last, rows], minlength=k) - post[last, rows].sum(0)
        g["w"][g_ids] = np.add.reduceat(g_em.reshape(t_max * n, k).astype(np.float32)[gw], g_starts, axis=0)
        return n, g

    def row(self, feats: tuple[str, ...]) -> np.ndarray:
        """Scores of one position for every label; features never seen count nothing."""
        ids = self.ids
        at = [ids[f] for f in feats if f in ids]
        return self.w[at].sum(0) if at else np.zeros(len(self.labels), np.float32)

    def viterbi(self, em: np.ndarray, lens: np.ndarray, cells: int = 200_000) -> np.ndarray:
        """Best label of every position; ``em`` holds the sequences one after the other, decoded in padded groups of like length."""
        out = np.zeros(len(em), np.int8)
        firsts = np.cumsum(lens) - lens
        order = np.argsort(lens, kind="stable")
        order = order[lens[order] > 0]
        at = 0
        while at < order.size:
            end = min(order.size, at + 2048)
            while end > at + 1 and lens[order[end - 1]] * (end - at) > cells:
                end = at + max(1, (end - at) // 2)
            grp = order[at:end]
            at = end
            n, t_max = lens[grp], int(lens[grp].max())
            idx = np.minimum(firsts[grp][None, :] + np.arange(t_max)[:, None], len(em) - 1)
            v = self.start + em[idx[0]]
            back = np.zeros((t_max, grp.size, v.shape[1]), np.int8)
            final = np.where((n == 1)[:, None], v, 0)
            step, better = np.empty_like(v), np.empty(v.shape, bool)
            for t in range(1, t_max):
                # the best label before, one after the other; of equal ones the first
                best = v[:, :1] + self.trans[0]
                for f in range(1, len(self.labels)):
                    np.add(v[:, f : f + 1], self.trans[f], out=step)
                    np.greater(step, best, out=better)
                    np.maximum(best, step, out=best)
                    np.putmask(back[t], better, f)
                v = best + em[idx[t]]
                final = np.where((n == t + 1)[:, None], v, final)
            cur = (final + self.end).argmax(1)
            rows = np.arange(grp.size)
            for t in range(t_max - 1, -1, -1):
                live = n > t
                out[idx[t][live]] = cur[live]
                if t:
                    cur = np.where(live, back[t, rows, cur], cur)
        return out
