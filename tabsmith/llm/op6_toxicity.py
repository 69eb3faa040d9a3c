"""Toxicity: maximum-scoring segments over token log-odds.

*Weights.* A token stands for its word and for its first four, five and six
letters, so unseen inflections of a known stem count too. Log-odds between
toxic and other texts carry an informative Dirichlet prior (the keys' shares in
all fitted texts); a key's weight is the lower confidence bound of its log-odds,
and only keys of clearly positive weight are kept. All other tokens cost ``DRIFT``.

*Segments.* One scan finds every passage whose sum cannot be raised by moving an
end: tokens without weight only matter by their number, so the scan is linear
in the text and touches the weighted tokens alone.

*Calibration.* Maximal segment sums of harmless texts follow an extreme-value
law: with ``lambda`` solved from their token scores and ``K`` fitted to their
maxima, a passage of sum ``S`` in ``n`` tokens is expected ``K n exp(-lambda S)`` times
by chance. A text's evidence is the sum of ``-log`` of that over its significant
passages, and a logistic curve turns it into the score. Weights are learned on
one half of the fitted texts and the curve on the other, both ways round.

At most ``SAMPLE`` labelled texts are fitted on (chosen by a hash of their ids);
every whole text is scored.

Cases: NULL and empty texts hold no passage and get the score of no evidence;
without labels, or with one class only, every score is the share of label 1 (0
without any); rows that repeat an id each get their row; an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_mod, labelled_sample, logistic, written

SAMPLE = 12_000
PRIOR, LEAST_TEXTS, LOWER, KEEP, DRIFT = 10.0, 4, 2.0, 1.5, 0.5
STEMS = (4, 5, 6)
#: Passages expected more often than this by chance are not significant.
SIGNIFICANT = 0.05
_WORD = re.compile(r"\w+")


def keys_of(word: str) -> list[str]:
    """The word itself, closed by a mark, and its stems."""
    return [word + "$", *(word[:k] for k in STEMS if len(word) > k)]


class Weights(dict):
    """Lower-case token -> score; tokens are split into words when first met."""

    def __init__(self, weights: dict[str, float], limit: int = 500_000):
        super().__init__()
        self.weights, self.limit = weights, limit

    def __missing__(self, token: str) -> float:
        if len(self) >= self.limit:
            self.clear()
        best = max((self.weights.get(k, 0.0) for w in _WORD.findall(token) for k in keys_of(w)), default=0.0)
        self[token] = best
        return best

    def of(self, text: str | None) -> np.ndarray:
        tokens = text.lower().split() if text else []
        return np.fromiter(map(self.__getitem__, tokens), float, len(tokens))


def segments(weights: np.ndarray, drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, end, sum) of the scores
    ``weight - drift``, in order of the text.

    Kept candidates carry the running sums before and after them. A new one joins
    back with those that it dominates: the last one that begins lower, if that one
    also ends lower.
    """
    kept: list[tuple[int, int, float, float]] = []
    total, last = 0.0, 0
    for at in np.flatnonzero(weights > drift):
        at = int(at)
        total -= drift * (at - last)
        before, total, last = total, total + float(weights[at]) - drift, at + 1
        first, end, left, right = at, at + 1, before, total
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j -= 1
            if j < 0 or kept[j][3] >= right:
                kept.append((first, end, left, right))
                break
            first, left = kept[j][0], kept[j][2]
            del kept[j:]
    return [(first, end, right - left) for first, end, left, right in kept]


def key_counts(sample: DataFrame) -> DataFrame:
    """(key, half, label, n): number of distinct texts that hold the key."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter = Counter()
            for text, half, label in zip(batch["text"], batch["half"], batch["label"]):
                words = set(_WORD.findall((text or "").lower()))
                counts.update((k, half, label) for k in {k for w in words for k in keys_of(w)})
            yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["key", "half", "label", "n"])

    return sample.mapInPandas(run, "key string, half int, label int, n long").groupBy("key", "half", "label").agg(
        F.sum("n").alias("n"))


def weights_of(keys, t: np.ndarray, c: np.ndarray, texts_t: int, texts_c: int) -> dict[str, float]:
    """Positive weights of ``keys`` that ``t`` of ``texts_t`` toxic and ``c`` of ``texts_c``
    other texts hold; the prior is worth ``PRIOR`` texts with the keys' overall shares."""
    prior = np.maximum(1e-9, PRIOR * (t + c) / max(1, texts_t + texts_c))
    odds = np.log((t + prior) / (texts_t + PRIOR - t - prior)) - np.log((c + prior) / (texts_c + PRIOR - c - prior))
    low = odds - LOWER * np.sqrt(1 / (t + prior) + 1 / (c + prior))
    return {k: float(w) for k, n, w in zip(keys, t, low) if w > KEEP and n >= LEAST_TEXTS}


class Calibration:
    """Extreme-value law of harmless texts, then a logistic curve over evidence."""

    def __init__(self, values: np.ndarray, shares: np.ndarray, sizes: np.ndarray, maxima: np.ndarray):
        """``values``, ``shares``: distribution of token scores in harmless texts;
        ``sizes``, ``maxima``: their tokens and best sums."""
        lo, hi = 1e-3, 20.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if (shares * np.exp(np.clip(mid * values, -700, 700))).sum() < 1 else (lo, mid)
        self.rate = lo
        # maximum-likelihood K of exp(-K n exp(-rate S)) with one text's worth of prior
        self.k = (len(sizes) + 1) / ((sizes * np.exp(-self.rate * maxima)).sum() + 1) if len(sizes) else 1.0
        self.slope, self.shift = 1.0, -3.0

    def evidence(self, sums: list[float], n: int) -> float:
        expected = [np.log(self.k * max(1, n)) - self.rate * s for s in sums]
        return float(sum(max(0.0, -e) for e in expected if e < np.log(SIGNIFICANT)))

    def learn(self, evidence: np.ndarray, y: np.ndarray) -> None:
        x, beta = np.stack([np.log1p(evidence), np.ones(len(y))], 1), np.zeros(2)
        for _ in range(50):
            p = logistic(x @ beta)
            # a small ridge keeps the curve finite where the classes are apart
            h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
            beta += np.linalg.solve(h, x.T @ (y - p) - 1e-2 * beta)
        self.slope, self.shift = max(0.0, float(beta[0])), float(beta[1])

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return logistic(self.slope * np.log1p(evidence) + self.shift)


class Model:
    def __init__(self, weights: dict[str, float], law: Calibration | None, constant: float = 0.0):
        self.weights, self.law, self.constant = weights, law, constant

    def passages(self, text: str | None, known: Weights) -> list[tuple[int, int, float]]:
        """Significant passages: first token, end, sum."""
        w = known.of(text)
        return [s for s in segments(w) if self.law.evidence([s[2]], len(w)) > 0] if self.law else []

    def score(self, texts, known: Weights) -> np.ndarray:
        if self.law is None:
            return np.full(len(texts), self.constant)
        found = np.zeros(len(texts))
        for i, text in enumerate(texts):
            w = known.of(text)
            if (w > DRIFT).any():
                found[i] = self.law.evidence([s for _, _, s in segments(w)], len(w))
        return self.law.score(found)


def fit(docs: DataFrame, labels: DataFrame, modulo: int = 3, held_out: int = 1, sample: int = SAMPLE) -> Model:
    """The model of ``labels.toxic`` over at most ``sample`` labelled texts."""
    rows = written(labelled_sample(docs, labels, "toxic", modulo, held_out, sample)
                   .withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int"))
                   .dropDuplicates(["text"]).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id"),
                   "op6-sample")
    # of the sample's keys only those that some toxic texts hold can get a weight
    flat = (key_counts(rows).groupBy("key").agg(*[F.sum(F.when((F.col("half") == h) & (F.col("label") == v), F.col("n"))
                                                        .otherwise(0)).alias(f"{name}{h}")
                                                  for h in (0, 1) for v, name in ((1, "toxic"), (0, "clean"))]))
    n = {(r["half"], r["label"]): r["count"] for r in rows.groupBy("half", "label").count().collect()}
    toxic, clean = (sum(n.get((h, v), 0) for h in (0, 1)) for v in (1, 0))
    if not toxic or not clean:
        return Model({}, None, float(bool(toxic)))
    # only keys that toxic texts hold more often than others can get a weight
    kept = (flat.where(f"toxic0 + toxic1 >= {LEAST_TEXTS} AND (toxic0 + toxic1) * {clean} > 2 * (clean0 + clean1) * {toxic}")
            .orderBy("key").toPandas())

    def of(halves) -> dict[str, float]:
        t, c = (sum(kept[f"{x}{h}"] for h in halves).to_numpy(float) for x in ("toxic", "clean"))
        return weights_of(kept["key"], t, c, *(sum(n.get((h, v), 0) for h in halves) for v in (1, 0)))

    other = {h: of([1 - h]) for h in (0, 1)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = {h: Weights(other[h]) for h in other}
        for batch in batches:
            out = []
            for text, half, label in zip(batch["text"], batch["half"], batch["label"]):
                w = known[half].of(text)
                out.append((label, len(w), [s for _, _, s in segments(w)], w[w > 0].round(3).tolist()))
            yield pd.DataFrame(out, columns=["label", "n", "sums", "positive"])

    seen = rows.mapInPandas(run, "label int, n long, sums array<double>, positive array<double>").orderBy(
        "label", "n", "sums", "positive").toPandas()
    y, clean = seen["label"].to_numpy(float), seen["label"] == 0
    scores = Counter(x for p in seen["positive"][clean] for x in p)
    size = int(seen["n"][clean].sum())
    values = np.array([0.0, *scores]) - DRIFT
    shares = np.array([max(1, size - sum(scores.values())), *scores.values()], float) / max(1, size)
    maxima = np.array([max(s, default=0.0) for s in seen["sums"][clean]])
    law = Calibration(values, shares, seen["n"][clean].to_numpy(float), maxima)
    law.learn(np.array([law.evidence(list(s), k) for s, k in zip(seen["sums"], seen["n"])]), y)
    return Model(of([0, 1]), law)


def toxicity(docs: DataFrame, labels: DataFrame, modulo: int = 3, held_out: int = 1, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_passages) of every text."""
    model = fit(docs, labels, modulo, held_out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Weights(model.weights)
        for batch in batches:
            score = model.score(list(batch["text"]), known)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": score,
                                "predicted": (score >= threshold).astype(np.int32)})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", (crc32_mod("doc_id", modulo) == held_out).alias("held_out")).mapInPandas(
        run, f"doc_id {id_type}, held_out boolean, score double, predicted int")


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, first, end, sum): every significant passage, in tokens."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Weights(model.weights)
        for batch in batches:
            yield pd.DataFrame([(key, *s) for key, text in zip(batch["doc_id"], batch["text"])
                                for s in model.passages(text, known)], columns=["doc_id", "first", "end", "sum"])

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, first long, end long, sum double")
