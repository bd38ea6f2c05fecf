"""A character-level bidirectional LSTM with CRF transitions, in numpy: training by Adam, Viterbi decoding."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SYMBOLS = 100  # printable ASCII, line break, other letters, everything else
FORBIDDEN = -1e4


def symbols_of(points: np.ndarray) -> np.ndarray:
    """Code points as symbol numbers."""
    out = np.full(len(points), 97, dtype=np.int64)
    ascii_ = (points >= 32) & (points < 127)
    out[ascii_] = points[ascii_] - 32
    out[points == 10] = 95
    out[points >= 0xC0] = 96
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _lstm(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray) -> dict:
    """x: time x batch x inputs. Keeps what the backward pass needs."""
    steps, batch, hidden = x.shape[0], x.shape[1], u.shape[0]
    h, c = np.zeros((steps + 1, batch, hidden)), np.zeros((steps + 1, batch, hidden))
    gates = x @ w + b
    for t in range(steps):
        g = gates[t] + h[t] @ u
        g[:, : 3 * hidden] = _sigmoid(g[:, : 3 * hidden])
        g[:, 3 * hidden :] = np.tanh(g[:, 3 * hidden :])
        i, f, o, n = (g[:, k * hidden : (k + 1) * hidden] for k in range(4))
        c[t + 1] = f * c[t] + i * n
        h[t + 1] = o * np.tanh(c[t + 1])
        gates[t] = g
    return {"x": x, "h": h, "c": c, "g": gates}


def _lstm_back(kept: dict, w: np.ndarray, u: np.ndarray, dh_all: np.ndarray):
    x, h, c, gates = kept["x"], kept["h"], kept["c"], kept["g"]
    steps, hidden = x.shape[0], u.shape[0]
    dh, dc = np.zeros_like(h[0]), np.zeros_like(c[0])
    dg_all = np.zeros_like(gates)
    for t in reversed(range(steps)):
        i, f, o, n = (gates[t][:, k * hidden : (k + 1) * hidden] for k in range(4))
        dh = dh + dh_all[t]
        tc = np.tanh(c[t + 1])
        dc = dc + dh * o * (1 - tc**2)
        dg_all[t] = np.concatenate(
            [dc * n * i * (1 - i), dc * c[t] * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - n**2)], axis=1
        )
        dh, dc = dg_all[t] @ u.T, dc * f
    du = np.einsum("tbh,tbg->hg", h[:-1], dg_all)
    dw = np.einsum("tbi,tbg->ig", x, dg_all)
    return dg_all @ w.T, dw, du, dg_all.sum(axis=(0, 1))


@dataclass
class Tagger:
    """Tags: 0 outside; 2k + 1 begins and 2k + 2 goes on in a span of kind k."""

    kinds: int
    values: dict

    @classmethod
    def fresh(cls, kinds: int, *, hidden: int = 12, width: int = 8, seed: int = 29) -> Tagger:
        rng, tags = np.random.default_rng(seed), 2 * kinds + 1
        values = {"e": rng.normal(0, 0.3, (SYMBOLS, width)), "v": rng.normal(0, 0.2, (2 * hidden, tags)), "vb": np.zeros(tags)}
        for side in "fb":
            values["w" + side] = rng.normal(0, 0.3, (width, 4 * hidden))
            values["u" + side] = rng.normal(0, 0.2, (hidden, 4 * hidden))
            values["b" + side] = np.repeat([0.0, 1.0, 0.0, 0.0], hidden)
        values["m"] = np.zeros((tags, tags))  # transitions, from row to column
        return cls(kinds, values)

    def forbidden(self) -> np.ndarray:
        """A span goes on only after it began."""
        tags = 2 * self.kinds + 1
        out = np.zeros((tags, tags))
        for k in range(self.kinds):
            out[:, 2 * k + 2] = FORBIDDEN
            out[[2 * k + 1, 2 * k + 2], 2 * k + 2] = 0
        return out

    def _emissions(self, symbols: np.ndarray):
        v = self.values
        x = v["e"][symbols.T]
        ahead = _lstm(x, v["wf"], v["uf"], v["bf"])
        back = _lstm(x[::-1], v["wb"], v["ub"], v["bb"])
        h = np.concatenate([ahead["h"][1:], back["h"][1:][::-1]], axis=2)
        return h @ v["v"] + v["vb"], h, ahead, back

    def loss_and_slopes(self, symbols: np.ndarray, tags: np.ndarray):
        """Mean negative log likelihood of windows (batch x time) and its gradient."""
        v = self.values
        em, h, ahead, back = self._emissions(symbols)
        steps, batch, number = em.shape
        move = v["m"] + self.forbidden()
        start = np.zeros(number)
        start[2::2] = FORBIDDEN
        alpha = np.zeros_like(em)
        alpha[0] = em[0] + start
        for t in range(1, steps):
            z = alpha[t - 1][:, :, None] + move[None]
            top = z.max(axis=1)
            alpha[t] = em[t] + top + np.log(np.exp(z - top[:, None]).sum(axis=1))
        beta = np.zeros_like(em)
        for t in range(steps - 2, -1, -1):
            z = move[None] + (em[t + 1] + beta[t + 1])[:, None, :]
            top = z.max(axis=2)
            beta[t] = top + np.log(np.exp(z - top[:, :, None]).sum(axis=2))
        top = alpha[-1].max(axis=1)
        norm = top + np.log(np.exp(alpha[-1] - top[:, None]).sum(axis=1))
        dem = np.exp(alpha + beta - norm[None, :, None])
        dm = np.zeros_like(v["m"])
        for t in range(1, steps):
            dm += np.exp(alpha[t - 1][:, :, None] + move[None] + (em[t] + beta[t])[:, None, :] - norm[:, None, None]).sum(axis=0)
        own = tags.T
        rows = np.arange(batch)
        gold = start[own[0]].sum()
        for t in range(steps):
            gold += em[t, rows, own[t]].sum()
            dem[t, rows, own[t]] -= 1
            if t:
                gold += move[own[t - 1], own[t]].sum()
                np.add.at(dm, (own[t - 1], own[t]), -1)
        dem /= batch
        slopes = {"m": dm / batch, "v": np.einsum("tbh,tbk->hk", h, dem), "vb": dem.sum(axis=(0, 1))}
        dh = dem @ v["v"].T
        hidden = v["uf"].shape[0]
        dxf, slopes["wf"], slopes["uf"], slopes["bf"] = _lstm_back(ahead, v["wf"], v["uf"], dh[:, :, :hidden])
        dxb, slopes["wb"], slopes["ub"], slopes["bb"] = _lstm_back(back, v["wb"], v["ub"], dh[::-1, :, hidden:])
        slopes["e"] = np.zeros_like(v["e"])
        np.add.at(slopes["e"], symbols.T, dxf + dxb[::-1])
        return (norm.sum() - gold) / batch, slopes

    def fit(self, symbols: np.ndarray, tags: np.ndarray, *, steps: int = 220, batch: int = 32, rate: float = 0.02, seed: int = 31):
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(x) for k, x in self.values.items()}
        second = {k: np.zeros_like(x) for k, x in self.values.items()}
        for step in range(1, steps + 1):
            rows = rng.integers(0, len(symbols), batch)
            _, slopes = self.loss_and_slopes(symbols[rows], tags[rows])
            size = np.sqrt(sum((s**2).sum() for s in slopes.values()))
            for k, s in slopes.items():
                s = s * min(1.0, 5.0 / max(size, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * s
                second[k] = 0.99 * second[k] + 0.01 * s * s
                pace = rate * (1 - step / (steps + 1))
                self.values[k] -= pace * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def decode(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tags of each window (batch x time), and by how much each beats the tag `outside`."""
        em = self._emissions(symbols)[0]
        steps, batch, number = em.shape
        move = self.values["m"] + self.forbidden()
        score = em[0].copy()
        score[:, 2::2] += FORBIDDEN
        came = np.zeros((steps, batch, number), dtype=np.int8)
        for t in range(1, steps):
            z = score[:, :, None] + move[None]
            came[t] = z.argmax(axis=1)
            score = z.max(axis=1) + em[t]
        tags = np.zeros((steps, batch), dtype=np.int64)
        tags[-1] = score.argmax(axis=1)
        rows = np.arange(batch)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = came[t, rows, tags[t]]
        margin = np.take_along_axis(em, tags[:, :, None], axis=2)[:, :, 0] - em[:, :, 0]
        return tags.T, margin.T
