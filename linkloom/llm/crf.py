"""Linear-chain conditional random field over categorical features, in numpy."""

from __future__ import annotations

import numpy as np


class LinearChainCRF:
    """Weights of one feature table and of label transitions; index 0 of the table is the unknown feature."""

    def __init__(self, n_features: int, n_labels: int):
        self.w = np.zeros((n_features, n_labels))
        self.trans = np.zeros((n_labels, n_labels))
        self.start = np.zeros(n_labels)
        self.stop = np.zeros(n_labels)

    def emissions(self, feats: np.ndarray) -> np.ndarray:
        """Scores [n, labels] of feature rows [n, features of a position]."""
        out = self.w[feats[:, 0]].copy()
        for column in range(1, feats.shape[1]):
            out += self.w[feats[:, column]]
        return out

    def fit(self, sequences: list[tuple[np.ndarray, np.ndarray]], epochs: int = 120, rate: float = 0.1, l2: float = 1e-3) -> LinearChainCRF:
        """Maximum likelihood by Adam; each sequence is (features [n, f], labels [n])."""
        sequences = sorted((s for s in sequences if len(s[1])), key=lambda s: -len(s[1]))
        if not sequences:
            return self
        sizes = np.array([len(y) for _, y in sequences])
        feats, gold = np.concatenate([x for x, _ in sequences]), np.concatenate([y for _, y in sequences])
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        ends = first + sizes - 1
        params = [self.w, self.trans, self.start, self.stop]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        inner = np.ones(len(gold), bool)
        inner[first] = False
        prev = np.flatnonzero(inner) - 1
        for step in range(1, epochs + 1):
            node, pair = self._marginals(self.emissions(feats), first, sizes)
            node[np.arange(len(gold)), gold] -= 1
            grads = [np.zeros_like(p) for p in params]
            for column in range(feats.shape[1]):
                for label in range(self.w.shape[1]):
                    grads[0][:, label] += np.bincount(feats[:, column], node[:, label], len(self.w))
            np.add.at(pair, (gold[prev], gold[prev + 1]), -1)
            grads[1], grads[2], grads[3] = pair, node[first].sum(0), node[ends].sum(0)
            for i, p in enumerate(params):
                g = grads[i] / len(sequences) + l2 * p
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        return self

    def _marginals(self, e: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label marginals of every position and expected transitions; sequences come longest first."""
        alpha, beta = np.empty_like(e), np.empty_like(e)
        alpha[first] = self.start + e[first]
        live = [int((sizes > t).sum()) for t in range(int(sizes[0]))]
        for t in range(1, len(live)):
            at = first[: live[t]] + t
            alpha[at] = _lse(alpha[at - 1][:, :, None] + self.trans, 1) + e[at]
        beta[first + sizes - 1] = self.stop
        for t in range(len(live) - 2, -1, -1):
            at = first[: live[t + 1]] + t
            beta[at] = _lse(self.trans + (e[at + 1] + beta[at + 1])[:, None, :], 2)
        z = np.repeat(_lse(alpha[first + sizes - 1] + self.stop, 1), sizes)
        pair = np.zeros_like(self.trans)
        inner = np.ones(len(e), bool)
        inner[first] = False
        at = np.flatnonzero(inner)
        for low in range(0, len(at), 100_000):
            i = at[low : low + 100_000]
            pair += np.exp(alpha[i - 1][:, :, None] + self.trans + (e[i] + beta[i])[:, None, :] - z[i][:, None, None]).sum(0)
        return np.exp(alpha + beta - z[:, None]), pair

    def viterbi(self, feats: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The best labels of many sequences, given end to end; ties go to the smaller label."""
        total, k = len(feats), len(self.start)
        out = np.zeros(total, np.int8)
        if not total:
            return out
        e = self.emissions(feats)
        sizes = np.asarray(sizes, np.int64)
        begins = np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] > 0]
        first, length = begins[order], sizes[order]
        live = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")
        back = np.zeros((total, k), np.int8)
        score = self.start + e[first]
        final = np.empty((len(order), k))
        for t in range(1, int(length[0])):
            n = int(live[t])
            final[n : len(score)] = score[n:]
            at = first[:n] + t
            paths = score[:n, :, None] + self.trans
            best = paths.argmax(1)
            back[at] = best
            score = np.take_along_axis(paths, best[:, None, :], 1)[:, 0] + e[at]
        final[: len(score)] = score
        label = (final + self.stop).argmax(1)
        for t in range(int(length[0]) - 1, -1, -1):
            n = int(live[t])
            at = first[:n] + t
            out[at] = label[:n]
            if t:
                label[:n] = back[at, label[:n]]
        return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)
