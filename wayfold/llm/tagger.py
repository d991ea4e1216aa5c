"""A character-level bidirectional LSTM with a CRF on top, in numpy: training by gradients written out, batched Viterbi decoding."""

from __future__ import annotations

import numpy as np

F32 = np.float32
FORBIDDEN = F32(-1e4)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return F32(0.5) * np.tanh(F32(0.5) * x) + F32(0.5)


class Tagger:
    """ids (batch, time) of `symbols` -> tags 0 .. tags - 1. Tag 0 is outside; odd tags begin a span, the even tag after continues it."""

    def __init__(self, symbols: int, tags: int, embed: int = 10, hidden: int = 14, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.hidden, self.tags = hidden, tags
        small = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(F32)
        self.p = {"E": small(symbols, embed) * F32(3), "W": small(2 * hidden, tags), "b": np.zeros(tags, F32), "T": np.zeros((tags, tags), F32), "S": np.zeros(tags, F32)}
        for d in "fr":
            self.p |= {f"X{d}": small(embed, 4 * hidden), f"H{d}": small(hidden, 4 * hidden), f"B{d}": np.zeros(4 * hidden, F32)}
            self.p[f"B{d}"][hidden : 2 * hidden] = 1
        inner = np.arange(2, tags, 2)
        self.open = np.ones((tags, tags), bool)
        self.open[:, inner] = False
        self.open[inner, inner] = self.open[inner - 1, inner] = True
        self.start_open = np.ones(tags, bool)
        self._forbid()

    def _forbid(self) -> None:
        self.p["T"][~self.open] = FORBIDDEN

    def _lstm(self, ids: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states (time, batch, 2 * hidden) of both directions, which run in step: the backward one over the reversed rows."""
        p, n, (batch, time) = self.p, self.hidden, ids.shape
        table = np.stack([p["E"] @ p[f"X{d}"] + p[f"B{d}"] for d in "fr"])
        inner = np.stack([p[f"H{d}"] for d in "fr"])
        both = np.stack((ids, ids[:, ::-1]))
        h = c = np.zeros((2, batch, n), F32)
        out, trace, side = np.empty((time, batch, 2 * n), F32), [], np.arange(2)[:, None]
        for t in range(time):
            z = table[side, both[:, :, t]] + h @ inner
            gates, g = _sigmoid(z[..., : 3 * n]), np.tanh(z[..., 3 * n :])
            before = c
            c = gates[..., n : 2 * n] * before + gates[..., :n] * g
            tc = np.tanh(c)
            if keep:
                trace.append((gates, g, before, tc, h))
            h = gates[..., 2 * n :] * tc
            out[t, :, :n], out[time - 1 - t, :, n:] = h
        return out, trace

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        return self._lstm(ids, False)[0] @ self.p["W"] + self.p["b"]

    def decode_runs(self, emissions: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The best tag sequence of runs of blocks: emissions (block, time, tag); begins marks the blocks that start a run, and a run starts and ends outside
        any known span. Blocks are reduced to the best scores from the tag before to the last tag, all at once; these are joined along the runs, all runs at once; then the
        way back is followed through the joints and the blocks."""
        n, time, _ = emissions.shape
        moves = self.p["T"].T  # to, from
        score = self.p["T"][None] + emissions[:, 0, None, :]  # block, tag before, tag
        back = np.zeros((time, n, self.tags, self.tags), np.int8)
        for t in range(1, time):
            best = np.full(score.shape, -np.inf, F32)
            for k in range(self.tags):
                way = score[:, :, k, None] + moves[None, None, :, k]
                better = way > best
                np.copyto(best, way, where=better)
                np.copyto(back[t], np.int8(k), where=better)
            score = best + emissions[:, t, None, :]
        first = np.flatnonzero(begins)
        length = np.diff(np.append(first, n))
        order = np.argsort(-length, kind="stable")  # long runs first, so that those that go on are a prefix
        first, length = first[order], length[order]
        at = np.full((len(first), self.tags), FORBIDDEN, F32)
        at[:, 0] = 0
        came = np.zeros((n, self.tags), np.int8)
        for k in range(int(length.max(initial=0))):
            live = int(np.searchsorted(-length, -k, "left"))
            ways = at[:live, :, None] + score[first[:live] + k]
            came[first[:live] + k] = ways.argmax(axis=1)
            at[:live] = ways.max(axis=1)
        entry, exit_ = np.zeros(n, np.int64), np.zeros(n, np.int64)
        now = at.argmax(axis=1)
        for k in range(int(length.max(initial=0)) - 1, -1, -1):
            live = int(np.searchsorted(-length, -k, "left"))
            block = first[:live] + k
            exit_[block] = now[:live]
            now[:live] = came[block, now[:live]]
            entry[block] = now[:live]
        out, rows = np.empty((n, time), np.int8), np.arange(n)
        out[:, -1] = exit_
        for t in range(time - 1, 0, -1):
            out[:, t - 1] = back[t][rows, entry, out[:, t]]
        return out

    def gradients(self, ids: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the gold tags, and its gradients."""
        p, n, (batch, time) = self.p, self.hidden, ids.shape
        hs, trace = self._lstm(ids, True)
        em = hs @ p["W"] + p["b"]
        # forward and backward sums, scaled to one at each step
        top = em.max(axis=2, keepdims=True)
        weight, moves = np.exp(em - top), np.exp(p["T"])
        alpha, beta, scale = np.empty_like(em), np.ones_like(em), np.empty((time, batch, 1), F32)
        now = weight[0] * np.exp(p["S"])
        for t in range(time):
            if t:
                now = (alpha[t - 1] @ moves) * weight[t]
            scale[t] = now.sum(axis=1, keepdims=True)
            alpha[t] = now / scale[t]
        into = weight / scale
        for t in range(time - 2, -1, -1):
            beta[t] = (into[t + 1] * beta[t + 1]) @ moves.T
        log_z = (np.log(scale) + top).sum(axis=(0, 2))
        d_em = alpha * beta
        pair = moves * (alpha[:-1].reshape(-1, self.tags).T @ (into[1:] * beta[1:]).reshape(-1, self.tags))
        rows, steps = np.arange(batch), np.arange(time)[:, None]
        tags = gold.T.astype(np.int64)
        score = em[steps, rows[None], tags].sum(0) + p["S"][tags[0]] + p["T"][tags[:-1], tags[1:]].sum(0)
        np.subtract.at(pair, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        d_em[steps, rows[None], tags] -= 1
        g = {"S": d_em[0].sum(0), "T": np.where(self.open, pair, 0).astype(F32), "W": hs.reshape(-1, 2 * n).T @ d_em.reshape(-1, self.tags), "b": d_em.sum((0, 1)), "E": np.zeros_like(p["E"])}
        d_h = d_em @ p["W"].T
        d_h = np.stack((d_h[:, :, :n], d_h[::-1, :, n:]), axis=1)  # time, direction, batch, hidden; the backward one in its own order
        inner = np.stack([p[f"H{d}"].T for d in "fr"])
        dz_all, dh, dc, d_rec = np.empty((time, 2, batch, 4 * n), F32), np.zeros((2, batch, n), F32), np.zeros((2, batch, n), F32), np.zeros((2, n, 4 * n), F32)
        for t in range(time - 1, -1, -1):
            gates, cand, before, tc, h = trace[t]
            dh = dh + d_h[t]
            i, f, o = gates[..., :n], gates[..., n : 2 * n], gates[..., 2 * n :]
            dc = dc + dh * o * (1 - tc * tc)
            dz = dz_all[t]
            np.multiply(dc * cand, i * (1 - i), out=dz[..., :n])
            np.multiply(dc * before, f * (1 - f), out=dz[..., n : 2 * n])
            np.multiply(dh * tc, o * (1 - o), out=dz[..., 2 * n : 3 * n])
            np.multiply(dc * i, 1 - cand * cand, out=dz[..., 3 * n :])
            d_rec += h.transpose(0, 2, 1) @ dz
            dh, dc = dz @ inner, dc * f
        for k, (d, rows_of) in enumerate(zip("fr", (ids, ids[:, ::-1]), strict=True)):
            hot = (rows_of.T.reshape(-1)[None] == np.arange(len(p["E"]))[:, None]).astype(F32)
            table = hot @ dz_all[:, k].reshape(-1, 4 * n)
            g |= {f"H{d}": d_rec[k], f"X{d}": p["E"].T @ table, f"B{d}": table.sum(0)}
            g["E"] += table @ p[f"X{d}"].T
        return float((log_z - score).mean()), {k: v / batch for k, v in g.items()}

    def train(self, ids: np.ndarray, gold: np.ndarray, steps: int = 300, batch: int = 48, rate: float = 0.01, seed: int = 9) -> float:
        """Adam over shuffled batches, the rate falling to a tenth; returns the mean loss of the last tenth of the steps."""
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        order, at, losses = rng.permutation(len(ids)), 0, []
        for step in range(1, steps + 1):
            if at + batch > len(order):
                order, at = rng.permutation(len(ids)), 0
            rows = order[at : at + batch]
            at += batch
            loss, g = self.gradients(ids[rows], gold[rows])
            losses.append(loss)
            norm = float(np.sqrt(sum((x * x).sum() for x in g.values())))
            now = rate * (1 - 0.9 * step / steps)
            for k, x in g.items():
                x = x * F32(min(1.0, 5.0 / (norm + 1e-9)))
                m[k] = F32(0.9) * m[k] + F32(0.1) * x
                v[k] = F32(0.99) * v[k] + F32(0.01) * x * x
                self.p[k] = self.p[k] - (F32(now) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + F32(1e-8))).astype(F32)
            self._forbid()
        return float(np.mean(losses[-max(1, steps // 10) :]))
