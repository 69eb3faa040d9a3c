"""Quality classifier: a generalised additive model with pairwise interactions.

Features are statistics of the whole text. The model is a sum of lookup tables:
one over the bins of each feature, and one over coarser bins of each of the
``PAIRS`` strongest pairs. Training goes round the features, each time adding a
shallow tree (three leaves) fitted to the residuals on that feature's bins, then
round the pairs (four leaves). Scoring bins the features of a batch of texts and
adds table entries.

The tables are fitted on at most ``SAMPLE`` labelled texts (chosen by a hash of
their ids); every text is scored.

Cases: NULL is the empty text, which gets a score like any other; without
labels, or with one class only, every score is the share of label 1 (0.5 without
any); rows that repeat an id each get their row; an empty table gives an empty
result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_mod, labelled_sample, logistic, remembers

SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 48, 8, 10
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1

NAMES = ["log_words", "letters", "upper", "digits", "spaces", "stops", "bars", "bangs", "symbols", "marks_in_words",
         "mean_word", "sd_word", "short_words", "distinct_words", "top_word", "repeated_neighbours", "distinct_pairs",
         "log_lines", "distinct_lines", "words_a_line", "capital_words", "plain_ends"]

_LOWER, _UPPER = np.zeros(256, bool), np.zeros(256, bool)
_LOWER[97:123] = _UPPER[65:91] = True
_HIGH = np.arange(256) >= 128
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) < 58)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_STOP = np.isin(np.arange(256), list(b".,;:?'\"()-"))
_MARK = ~(_LOWER | _UPPER | _HIGH | _DIGIT | _SPACE | _STOP)


def features(text: str | None) -> list[float]:
    """One value for each of ``NAMES``; linear in the text."""
    data = (text or "").encode()
    raw = np.frombuffer(data, np.uint8)
    n, hist = max(1, len(raw)), np.bincount(raw, minlength=256)
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    m = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    pairs = set(zip(words, words[1:]))
    letters = hist[_LOWER | _UPPER | _HIGH].sum()
    # words whose last byte is neither a letter, a digit nor a usual stop
    last = np.fromiter((w[-1] for w in words), np.uint8, len(words))
    first = np.fromiter((w[0] for w in words), np.uint8, len(words))
    mark_end = _MARK[last].sum() if words else 0
    return [np.log1p(len(words)), letters / n, hist[_UPPER].sum() / max(1, letters), hist[_DIGIT].sum() / n,
            hist[_SPACE].sum() / n, hist[_STOP].sum() / n, hist[124] / m, hist[33] / m, hist[_MARK].sum() / n, mark_end / m,
            lengths.mean(), lengths.std(), (lengths <= 3).mean(), len(seen) / m, max(seen.values(), default=0) / m,
            (len(words) - 1 - sum(map(bytes.__ne__, words, words[1:]))) / m if words else 0, len(pairs) / m,
            np.log1p(len(lines)), len(set(lines)) / max(1, len(lines)), m / max(1, len(lines)),
            _UPPER[first].mean() if words else 0, (_LOWER | _UPPER | _HIGH)[last].mean() if words else 0]


def best_cuts(grad: np.ndarray, weight: np.ndarray, cuts: int) -> np.ndarray:
    """Leaf value for each bin of a tree with ``cuts`` cuts over ordered bins."""
    edges = [0, len(grad)]
    g, w = np.append(0, np.cumsum(grad)), np.append(0, np.cumsum(weight))
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (w[b] - w[a] + 1)
    for _ in range(cuts):
        best = (1e-12, None)
        for lo, hi in zip(edges, edges[1:]):
            if hi - lo > 1:
                c = np.arange(lo + 1, hi)
                found = gain(lo, c) + gain(c, hi) - gain(lo, hi)
                k = int(found.argmax())
                best = max(best, (float(found[k]), int(c[k])), key=lambda x: x[0])
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    out = np.empty(len(grad))
    for lo, hi in zip(edges, edges[1:]):
        out[lo:hi] = (g[hi] - g[lo]) / (w[hi] - w[lo] + 1)
    return out


def best_quarters(grad: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best cut into four over two axes of bins."""
    g, w = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (grad, weight))
    n, m = grad.shape
    parts = lambda t: (t[1:n, 1:m], t[1:n, m:] - t[1:n, 1:m], t[n:, 1:m] - t[1:n, 1:m],
                       t[n:, m:] - t[n:, 1:m] - t[1:n, m:] + t[1:n, 1:m])
    total = sum(a ** 2 / (b + 1) for a, b in zip(parts(g), parts(w)))
    i, j = np.unravel_index(total.argmax(), total.shape)
    values = [float((a / (b + 1))[i, j]) for a, b in zip(parts(g), parts(w))]
    out = np.empty((n, m))
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = values
    return float(total[i, j]), out


class AdditiveModel:
    """Sum of lookup tables over binned features and pairs of them."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        k = x.shape[1] if x.ndim == 2 else 0
        share = (y.sum() + 0.5) / (len(y) + 1)
        self.base, self.tables, self.pairs = float(np.log(share / (1 - share))), [], []
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.empty(0) for f in range(k)]
        self.coarse = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) if len(x) else np.empty(0) for f in range(k)]
        if not 0 < y.sum() < len(y):
            return
        fine, rough = self._bins(x, self.edges), self._bins(x, self.coarse)
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        z = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            for f, table in enumerate(self.tables):
                step = RATE * best_cuts(*self._sums(z, y, fine[f], len(table)), 2)
                table += step
                z += step[fine[f]]
        found = []
        for a in range(k):
            for b in range(a):
                shape = (len(self.coarse[a]) + 1, len(self.coarse[b]) + 1)
                if min(shape) > 1:
                    cell = rough[a] * shape[1] + rough[b]
                    sums = self._sums(z, y, cell, shape[0] * shape[1])
                    found.append((best_quarters(*(s.reshape(shape) for s in sums))[0], a, b, shape, cell))
        found.sort(key=lambda t: -t[0])
        self.pairs = [(a, b, np.zeros(shape)) for _, a, b, shape, _ in found[:PAIRS]]
        for _ in range(PAIR_ROUNDS):
            for (_, _, _, shape, cell), (_, _, table) in zip(found, self.pairs):
                step = RATE * best_quarters(*(s.reshape(shape) for s in self._sums(z, y, cell, shape[0] * shape[1])))[1]
                table += step
                z += step.ravel()[cell]

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]

    @staticmethod
    def _sums(z, y, cell, n) -> tuple[np.ndarray, np.ndarray]:
        p = logistic(z)
        return np.bincount(cell, y - p, n), np.bincount(cell, p * (1 - p), n)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for table, at in zip(self.tables, self._bins(x, self.edges)):
            z += table[at]
        if self.pairs:
            rough = self._bins(x, self.coarse)
            for a, b, table in self.pairs:
                z += table[rough[a], rough[b]]
        return logistic(z)


def _matrix(texts) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(len(texts), len(NAMES))


def fit(docs: DataFrame, labels: DataFrame, modulo: int = 5, held_out: int = 0, sample: int = SAMPLE) -> AdditiveModel:
    """The model of ``labels.quality`` over at most ``sample`` labelled texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remembers("op10", dict)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "x": list(_matrix(batch["text"]))})

    rows = labelled_sample(docs, labels, "quality", modulo, held_out, sample).mapInPandas(
        run, "doc_id long, label int, x array<double>").orderBy("doc_id", "x").toPandas()
    x = np.stack(rows["x"]) if len(rows) else np.empty((0, len(NAMES)))
    return AdditiveModel(x, rows["label"].to_numpy(float))


def scored(docs: DataFrame, model: AdditiveModel, threshold: float = 0.3) -> DataFrame:
    """All columns of ``docs`` with score and predicted (replaced where present)."""
    keep = [f for f in docs.schema if f.name not in ("score", "predicted")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remembers("op10", dict)
        for batch in batches:
            score = model.score(_matrix(batch["text"]))
            yield batch.assign(score=score, predicted=(score >= threshold).astype(np.int32))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return docs.select(*[f.name for f in keep]).mapInPandas(run, f"{fields}, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, modulo: int = 5, held_out: int = 0, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every text."""
    model = fit(docs, labels, modulo, held_out)
    return scored(docs.select("doc_id", "text"), model, threshold).select(
        "doc_id", (crc32_mod("doc_id", modulo) == held_out).alias("held_out"), "score", "predicted")
