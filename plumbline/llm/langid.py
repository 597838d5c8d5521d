"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into windows of WINDOW bytes, all of them; in each window one GRU reads forwards and
one backwards, and a softmax over both states labels every byte position with a language.  A
document's probabilities are the mean over all its positions.  The network is trained here, in
numpy, by backpropagation through time and Adam, on windows of a bounded sample of labelled rows
(TRAIN_ROWS).  Of a row's windows, from all over its text, up to ROW_WINDOWS are drawn, each weighing as many windows
as it stands for, so that every part of a long text counts.  Rows are counted by language first:
each language has an equal quota of the sample, what rare ones leave over goes to the others, and
within a language rows are taken by hash of the id, the one with the least hash always.  So every
language of a row that may be learnt from is a class at every size; only beyond TRAIN_ROWS languages
is the sample larger, with one row each.  Everything is seeded: the same rows give the same network.

Gates use the softsign pair x / (1 + |x|) instead of tanh and the logistic function, which keeps a
step to a few vector operations.

Edge cases: a null text or one without a letter (Unicode category L) is `und` with score 0; without
any labelled row, as in an empty table, every text is `und`; one learnt language is predicted with
score 1; of languages with equal probabilities the first by name is predicted; very long texts are
read whole, a bounded number of windows at a time; repeated rows get equal results; only doc_id, text
and (for learning) lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out
from .textvec import flat, steps

WINDOW = 128
TRAIN_WINDOW = 64
UNITS = 8
TRAIN_ROWS = 4_000
ROW_WINDOWS = 8
BATCHES = 260
BATCH = 256
PAD = 256
_LETTER = regex.compile(r"\p{L}")
_BLOCK = 2048
f4 = np.float32


def softsign(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _slope(s: np.ndarray) -> np.ndarray:
    """The derivative of softsign at the place where its value is s."""
    return (1 - np.abs(s)) ** 2


class BiGru:
    """Parameters by name; arrays are features x windows, so that gates are contiguous."""

    def __init__(self, classes: list[str], units: int = UNITS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes, self.units = classes, units
        draw = lambda *shape, s: rng.normal(0, s, shape).astype(f4)
        self.p = {}
        for d in "fb":
            table = draw(PAD + 1, 3 * units, s=0.5)
            table[:, :units] += 1.0  # update gates start half closed
            self.p |= {"x" + d: table, "u" + d: draw(3 * units, units, s=0.3), "c" + d: np.zeros((units, 1), f4)}
        self.p |= {"v": draw(len(classes), 2 * units, s=0.3), "o": np.zeros((len(classes), 1), f4)}

    def _read(self, d: str, steps_: np.ndarray, keep: bool) -> tuple[list, list]:
        """States after each of the byte rows, and what the way back needs."""
        h_n = self.units
        table, u, c = self.p["x" + d], self.p["u" + d], self.p["c" + d]
        h = np.zeros((h_n, steps_.shape[1]), f4)
        states, trace = [], []
        for row in steps_:
            a = np.ascontiguousarray(table[row].T)
            g = u @ h
            zr = softsign(a[: 2 * h_n] + g[: 2 * h_n])
            zr *= f4(0.5)
            zr += f4(0.5)
            real = (row != PAD).astype(f4) if keep else None
            z, r = zr[:h_n], zr[h_n:]
            q = g[2 * h_n :] + c
            n = softsign(a[2 * h_n :] + r * q)
            before = h
            h = n + z * (h - n)
            pad = row == PAD
            if pad.any():  # padding leaves the state as it is
                h[:, pad] = before[:, pad]
            states.append(h)
            if keep:
                trace.append((row, before, z, r, q, n, real))
        return states, trace

    def _softmax(self, hf: np.ndarray, hb: np.ndarray) -> np.ndarray:
        v = self.p["v"]
        y = v[:, : self.units] @ hf + v[:, self.units :] @ hb + self.p["o"]
        y -= y.max(axis=0)
        np.exp(y, out=y)
        y /= y.sum(axis=0)
        return y

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """Sums of the position probabilities of each window (windows x classes); rows of windows are bytes or PAD."""
        rows = np.ascontiguousarray(windows.T)
        forwards, _ = self._read("f", rows, False)
        backwards, _ = self._read("b", rows[::-1], False)
        out = np.zeros((len(self.classes), len(windows)), f4)
        for t, row in enumerate(rows):
            out += self._softmax(forwards[t], backwards[len(rows) - 1 - t]) * (row != PAD)
        return out.T

    def gradients(self, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean weighted cross entropy over all positions and its gradients."""
        rows = np.ascontiguousarray(windows.T)
        steps_ = len(rows)
        fwd, ft = self._read("f", rows, True)
        bwd, bt = self._read("b", rows[::-1], True)
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        h_n, v, loss = self.units, self.p["v"], 0.0
        scale = (rows != PAD) * weights
        scale = (scale / max(scale.sum(), 1e-9)).astype(f4)
        df, db = [None] * steps_, [None] * steps_
        for t in range(steps_):
            hf, hb = fwd[t], bwd[steps_ - 1 - t]
            y = self._softmax(hf, hb)
            loss -= float((np.log(y[labels, np.arange(len(labels))] + 1e-12) * scale[t]).sum())
            y[labels, np.arange(len(labels))] -= 1
            y *= scale[t]
            grad["v"] += np.concatenate([y @ hf.T, y @ hb.T], axis=1)
            grad["o"] += y.sum(axis=1, keepdims=True)
            df[t], db[steps_ - 1 - t] = v[:, :h_n].T @ y, v[:, h_n:].T @ y
        for d, trace, dstate in (("f", ft, df), ("b", bt, db)):
            u = self.p["u" + d]
            dh = np.zeros_like(fwd[0])
            gx, gu, gc = grad["x" + d], grad["u" + d], grad["c" + d]
            for t in range(steps_ - 1, -1, -1):
                row, before, z, r, q, n, real = trace[t]
                dh = dh + dstate[t]
                skipped = dh * (1 - real)
                dh = dh * real
                dn = dh * (1 - z) * _slope(n)
                dz = dh * (before - n) * f4(0.5) * _slope(2 * z - 1)
                dr = dn * q * f4(0.5) * _slope(2 * r - 1)
                dq = dn * r
                through = np.concatenate([dz, dr, dq])
                gu += through @ before.T
                gc += dq.sum(axis=1, keepdims=True)
                np.add.at(gx, row, np.concatenate([dz, dr, dn]).T)
                dh = dh * z + u.T @ through + skipped
        return loss, grad


def train(windows: np.ndarray, labels: np.ndarray, classes: list[str], stands_for: np.ndarray | None = None, *, units: int = UNITS, batches: int = BATCHES, batch: int = BATCH, rate: float = 0.03, seed: int = 7) -> BiGru:
    """Adam on random batches; windows are drawn by what they stand for, and languages weigh the same."""
    net = BiGru(classes, units, seed)
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    s = {k: np.zeros_like(v) for k, v in net.p.items()}
    stands_for = np.ones(len(windows)) if stands_for is None else stands_for
    per_class = np.bincount(labels, weights=stands_for, minlength=len(classes))
    weights = (1.0 / np.maximum(per_class, 1e-9))[labels]
    weights = (weights * stands_for.sum() / (weights * stands_for).sum()).astype(f4)
    chance = stands_for / stands_for.sum()
    for k in range(1, batches + 1):
        pick = rng.choice(len(windows), batch, p=chance)
        cut = int(rng.integers(0, windows.shape[1] - TRAIN_WINDOW + 1)) if windows.shape[1] > TRAIN_WINDOW else 0
        _, grad = net.gradients(windows[pick, cut : cut + TRAIN_WINDOW], labels[pick], weights[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        step = rate * min(1.0, 20 / k**0.5) * (1 - 0.9 * k / batches)
        for name, g in grad.items():
            g *= f4(min(1.0, 1.0 / (norm + 1e-9)))
            m[name] += f4(0.1) * (g - m[name])
            s[name] += f4(0.01) * (g * g - s[name])
            net.p[name] -= f4(step) * (m[name] / f4(1 - 0.9**k)) / (np.sqrt(s[name] / f4(1 - 0.99**k)) + f4(1e-8))
    return net


def cut(data: np.ndarray, off: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts (windows x size, PAD beyond a text's end) and the text of each."""
    count = -(-np.diff(off) // size)
    text = np.repeat(np.arange(len(count)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    at = (off[:-1][text] + k * size)[:, None] + np.arange(size)
    beyond = at >= off[1:][text][:, None]
    out = data[np.minimum(at, max(len(data) - 1, 0))].astype(np.int16) if len(data) else np.zeros(at.shape, np.int16)
    out[beyond] = PAD
    return out, text


def spread(data: np.ndarray, most: int, seed: int = 7) -> tuple[np.ndarray, float]:
    """Up to `most` windows of one text, one drawn from each of as many equal stretches of it, and how many each stands for."""
    windows, _ = cut(data, np.array([0, len(data)]))
    if len(windows) <= most:
        return windows, 1.0
    edges = np.linspace(0, len(windows), most + 1)
    at = edges[:-1] + np.random.default_rng([seed, len(data)]).random(most) * np.diff(edges)
    return windows[at.astype(int)], len(windows) / most


def quotas(counts: dict[str, int], total: int) -> dict[str, int]:
    """How many rows of each language are learnt from: equal shares, of which rare languages leave the rest to others; one at least."""
    out, left = {}, total
    for k, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[lang] = max(1, min(n, left // (len(counts) - k)))
        left = max(0, left - out[lang])
    return out


def sample(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Windows, labels, languages and weights of a bounded sample of the labelled rows that may be learnt from."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    part = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30))
    seen = {r["lang"]: r for r in rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(part).alias("least")).collect()}
    quota = quotas({k: r["n"] for k, r in seen.items()}, train_rows)
    below = [(k, max(int(quota[k] / r["n"] * (1 << 30)), r["least"]) + 1) for k, r in sorted(seen.items())]  # the least hash is always in
    bounds = docs.sparkSession.createDataFrame(below, "b_lang string, b_below long")
    rows = rows.join(F.broadcast(bounds), F.col("lang") == F.col("b_lang")).filter(part < F.col("b_below"))
    rows = rows.select("text", "lang", "doc_id")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in steps(batch.column(0)):
                data, off = flat(batch.column(0).slice(a, b - a))
                drawn = [spread(data[off[k] : off[k + 1]], ROW_WINDOWS) for k in range(b - a)]
                packed = [w.astype("<i2").tobytes() for w, _ in drawn]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array([x for _, x in drawn])], names=["windows", "lang", "doc_id", "stands_for"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = sorted(rows.mapInArrow(take, f"windows binary, lang string, doc_id {kind}, stands_for double").collect(), key=lambda r: (r["doc_id"], r["lang"], bytes(r["windows"])))
    classes = sorted({r["lang"] for r in found})
    parts = [np.frombuffer(r["windows"], "<i2").reshape(-1, WINDOW) for r in found]
    labels = np.repeat([classes.index(r["lang"]) for r in found], [len(p) for p in parts]) if found else np.zeros(0, int)
    stands_for = np.repeat([r["stands_for"] for r in found], [len(p) for p in parts]) if found else np.zeros(0)
    return (np.concatenate(parts) if parts else np.zeros((0, WINDOW), np.int16)), labels, classes, stands_for


def identify(docs: DataFrame, net: BiGru | None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, lang_pred, score."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in steps(batch.column(1)):
                part = batch.slice(a, b - a)
                lettered = np.array([bool(t) and _LETTER.search(t) is not None for t in part.column(1).to_pylist()], dtype=bool)
                pred, score = np.full(b - a, "und", dtype=object), np.zeros(b - a)
                if net is not None:
                    data, off = flat(part.column(1))
                    windows, owner = cut(data, off)
                    total = np.zeros((b - a, len(net.classes)))
                    for k in range(0, len(windows), _BLOCK):
                        np.add.at(total, owner[k : k + _BLOCK], net.pooled(windows[k : k + _BLOCK]))
                    mean = total / np.maximum(np.diff(off), 1)[:, None]
                    best = mean.argmax(axis=1)
                    pred = np.where(lettered, np.array(net.classes, dtype=object)[best], "und")
                    score = np.where(lettered, np.clip(mean[np.arange(b - a), best], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pred.tolist(), pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def language_id(docs: DataFrame, **columns: str) -> DataFrame:
    """Trains on the learning fold of docs and labels every document."""
    windows, labels, classes, stands_for = sample(docs, **columns)
    net = train(windows, labels, classes, stands_for) if len(windows) else None
    return identify(docs, net, **{k: v for k, v in columns.items() if k != "lang"})
