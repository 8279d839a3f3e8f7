"""Language identification by a byte convolutional network, trained in numpy on a bounded labelled sample.

The network reads windows of WINDOW bytes: filters of widths 2, 3 and 4 over the bytes, the largest value of each filter over
the window, and a softmax layer. A text's answer is the mean of its windows' probabilities, weighted by their bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.llm.common import kernel, pieces, utf8

WINDOW = 256
WIDTHS = (2, 3, 4)
UNDETERMINED = "und"


@dataclass(frozen=True)
class Training:
    """sample: labelled texts per language at most; excerpt: characters taken of each, from a place given by its hash."""

    sample: int = 300
    excerpt: int = 1024
    filters: int = 8
    epochs: int = 12
    batch: int = 64
    rate: float = 0.05
    seed: int = 7


@dataclass(frozen=True)
class Network:
    labels: tuple[str, ...]
    filters: tuple[np.ndarray, ...]  # for each width w: (w, 256, filters)
    bias: np.ndarray
    weights: np.ndarray  # (filters of all widths, labels)
    offset: np.ndarray
    pairs: np.ndarray  # (65536,): whether two bytes stood side by side in the windows that were learned


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of WINDOW bytes, the row that each belongs to, and the bytes of text in it; the last one is padded with 0."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[row] + nth * WINDOW
    length = np.minimum(WINDOW, offsets[row + 1] - start)
    cells = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < length[:, None]
    out = np.where(inside, data[np.minimum(cells, max(len(data) - 1, 0))] if len(data) else 0, 0).astype(np.uint8)
    return out, row, length


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit_arrays(x: np.ndarray, y: np.ndarray, labels: tuple[str, ...], how: Training) -> Network:
    """Adagrad on the cross entropy. x: (n, WINDOW) bytes, y: label numbers. The gradient of a pooled filter goes to
    the one place where it was largest."""
    rng = np.random.default_rng(how.seed)
    n, f = len(x), how.filters
    conv = [rng.normal(0, 0.3, (w, 256, f)).astype(np.float32) for w in WIDTHS]
    weights = rng.normal(0, 0.3, (f * len(WIDTHS), len(labels))).astype(np.float32)
    bias, offset = np.zeros(f * len(WIDTHS), np.float32), np.zeros(len(labels), np.float32)
    params = [*conv, bias, weights, offset]
    seen = [np.full_like(p, 1e-4) for p in params]
    for _ in range(how.epochs):
        order = rng.permutation(n)
        for at in range(0, n, how.batch):
            rows = order[at : at + how.batch]
            b, target = x[rows], y[rows]
            pooled, best = [], []
            for w, k in zip(WIDTHS, conv, strict=True):
                z = sum(k[j][b[:, j : WINDOW - w + 1 + j]] for j in range(w))
                top = z.argmax(1)
                best.append(top)
                pooled.append(np.take_along_axis(z, top[:, None], 1)[:, 0])
            pre = np.concatenate(pooled, 1) + bias
            hidden = np.tanh(pre)
            error = _softmax(hidden @ weights + offset)
            error[np.arange(len(rows)), target] -= 1
            error /= len(rows)
            back = (error @ weights.T) * (1 - hidden * hidden)
            grads = []
            for i, (w, k) in enumerate(zip(WIDTHS, conv, strict=True)):
                g = np.zeros_like(k)
                part = back[:, i * f : (i + 1) * f]
                for j in range(w):
                    byte = np.take_along_axis(b, best[i] + j, 1)
                    np.add.at(g[j], (byte, np.arange(f)[None, :]), part)
                grads.append(g)
            grads += [back.sum(0), hidden.T @ error, error.sum(0)]
            for p, g, s in zip(params, grads, seen, strict=True):
                s += g * g
                p -= how.rate * g / np.sqrt(s)
    pairs = np.zeros(65536, bool)
    pairs[x[:, :-1].astype(np.int32) * 256 + x[:, 1:]] = True
    return Network(labels, tuple(conv), bias, weights, offset, pairs)


class Scorer:
    """Forward pass. Two bytes together select a row of each table, so a window costs five table rows per byte."""

    def __init__(self, net: Network):
        two, three, four = net.filters
        join = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        self.two, self.three, self.tail = join(two[0], two[1]), join(three[0], three[1]), three[2]
        self.head4, self.tail4 = join(four[0], four[1]), join(four[2], four[3])
        self.net = net

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        pooled = [
            self.two[pair].max(1),
            (self.three[pair[:, :-1]] + self.tail[x[:, 2:]]).max(1),
            (self.head4[pair[:, :-2]] + self.tail4[pair[:, 2:]]).max(1),
        ]
        hidden = np.tanh(np.concatenate(pooled, 1) + self.net.bias)
        return _softmax(hidden @ self.net.weights + self.net.offset)

    def texts(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Label and mean probability of each text."""
        data, offsets = utf8(column)
        total = np.zeros((len(column), len(self.net.labels)))
        for a, b in pieces(offsets, 1 << 20):
            for x, row, length in self._parts(data, offsets[a : b + 1]):
                np.add.at(total, a + row, self.probabilities(x) * length[:, None])
        mass = total.sum(1)
        mean = total / np.where(mass > 0, mass, 1)[:, None]
        best = mean.argmax(1)
        score = np.clip(mean[np.arange(len(column)), best], 0.0, 1.0)
        names, values = [], score.astype(float)
        for i, text in enumerate(column.to_pylist()):
            if text is None or not any(map(str.isalpha, text)):
                names.append(UNDETERMINED)
                values[i] = 0.0
            else:
                names.append(self.net.labels[best[i]])
        return names, values

    @staticmethod
    def _parts(data, offsets):
        """Windows of these rows, some thousands at a time."""
        first = int(offsets[0])
        local = data[first : int(offsets[-1])]
        x, row, length = windows(local, offsets - first)
        for at in range(0, len(x), 4096):
            yield x[at : at + 4096], row[at : at + 4096], length[at : at + 4096]


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", how: Training | None = None) -> Network | None:
    """Train on at most `how.sample` texts per language, chosen by a hash of key and text; None if there is no labelled text.

    Only the bounded sample reaches the driver: the rate per language follows from one count, the rest is filtered in
    Spark. Rows with a null text or label are left out. Labels are taken in sorted order; the seed fixes the rest, so
    equal tables give equal networks.
    """
    how = how or Training()
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = tuple(sorted(counts))
    if not labels:
        return None
    draw = F.pmod(F.xxhash64(F.lit(how.seed), F.col(key), F.col(text)), F.lit(1_000_000))
    wanted = F.lit(False)
    for name in labels:
        wanted = wanted | ((F.col(lang) == name) & (draw < int(min(1.0, how.sample / counts[name]) * 1_000_000) + 1))
    place = 1 + F.pmod(F.xxhash64(F.col(key)), F.greatest(F.char_length(text) - how.excerpt + 1, F.lit(1))).cast("int")
    sample = rows.where(wanted).select(
        F.col(lang).alias("lang"), draw.alias("draw"), F.col(text).substr(place, F.lit(how.excerpt)).alias("text")
    )
    kept: dict[str, list[tuple[int, str]]] = {name: [] for name in labels}
    # whatever the keys are, no more rows than these reach the driver
    for r in sample.orderBy("draw", "lang", "text").limit(4 * how.sample * len(labels)).collect():
        kept[r["lang"]].append((r["draw"], r["text"]))
    x, y = [], []
    for number, name in enumerate(labels):
        texts = [t for _, t in sorted(kept[name])[: how.sample]]
        cells, _, length = windows(*utf8(pa.array(texts, pa.string())))
        cells = cells[length >= min(16, length.max(initial=0))]
        x.append(cells)
        y.append(np.full(len(cells), number))
    return fit_arrays(np.concatenate(x), np.concatenate(y), labels, how)


def identify(text: Column, net: Network | None) -> Column:
    """struct(lang, score) of each whole text. No letter or null text gives ("und", 0.0); no network gives that for all.

    Of equal means the first label in sorted order wins.
    """
    if net is None:
        return F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"))

    made: list[Scorer] = []  # one per task, built from the small network that the task received

    def predict(column: pa.Array) -> pa.Array:
        if not made:
            made.append(Scorer(net))
        names, values = made[0].texts(column)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.float64())], ["lang", "score"])

    return kernel(predict, "lang string, score double")(text)


def strange(text: Column, net: Network) -> Column:
    """struct(pairs, unseen) of each whole text: its pairs of neighbouring bytes, and those that no learned window had."""
    seen = net.pairs

    def count(column: pa.Array) -> pa.Array:
        data, offsets = utf8(column)
        unseen = np.zeros(len(column), np.int64)
        for a, b in pieces(offsets, 1 << 20):
            first = int(offsets[a])
            part = data[first : int(offsets[b])]
            new = np.zeros(len(part) + 1, np.int64)
            np.cumsum(~seen[part[:-1].astype(np.int32) * 256 + part[1:]], out=new[1 : len(part)])
            # new[i]: unseen pairs that begin before byte i; the pair over the end of a text is not counted
            start = offsets[a:b] - first
            unseen[a:b] = new[np.maximum(offsets[a + 1 : b + 1] - first - 1, start)] - new[start]
        pairs = np.maximum(np.diff(offsets) - 1, 0)
        return pa.StructArray.from_arrays([pa.array(pairs, pa.int64()), pa.array(unseen, pa.int64())], ["pairs", "unseen"])

    return kernel(count, "pairs long, unseen long")(text)
