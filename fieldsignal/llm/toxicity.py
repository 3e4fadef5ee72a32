"""Toxic passages: maximum-scoring segments over token log-odds, with extreme-value calibration.

Every word has a log-odds of standing in toxic rather than other labelled texts, with the words'
frequency in the whole corpus as the Dirichlet prior. What is not clearly more frequent in toxic
texts costs a constant, so chance passages stay short. A linear scan finds all maximal scoring
passages of a text. The best passages of chance follow an extreme-value law whose rate is the
root of the scores' moment equation over clean texts: passages of a score s or more are expected
``SPREAD * n * exp(-rate * s)`` times among n words. The least probable number of passages of a
text is its evidence, which a logistic curve over the training texts turns into a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldsignal.llm.common import map_arrow, utf8
from fieldsignal.session import materialize

#: Labelled rows that the model is fitted on at most: those whose ids hash lowest.
SAMPLE_ROWS = 20_000
#: Strength of the prior in tokens, least z of a toxic token, and cost of every other token.
PRIOR, LEAST_Z, COST = 50_000.0, 3.0, 1.5
#: A word that the model does not know is judged by its longest known beginning of such a length.
BEGINNINGS = (6, 5, 4)
#: Share of the words of a text where a passage of chance can begin, and the largest evidence.
SPREAD, MOST_EVIDENCE = 0.1, 20.0
FOLDS = 5
_WORDS = re.compile(r"[^\W\d_]+").findall


def held_out(doc_id: int | None) -> bool:
    """Rows that the labels are never learned from: the checksum of the id as text is 0 mod 5."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring passages (start, end, score), in linear time.

    Candidates keep the sums before and after them; a new one is joined to the last candidate
    that begins lower, if that ends lower too.
    """
    found: list[tuple[int, int, float, float]] = []
    total = 0.0
    for k, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        start, left, right = k, before, total
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= right:
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
        found.append((start, k + 1, left, right))
    return [(a, b, right - left) for a, b, left, right in found]


def _tokens(text: bytes) -> list[str]:
    return _WORDS(text.decode().lower())


def _counts(sample):
    """Tokens of a task's texts: in all of them, and in the toxic and the other texts of the sample."""

    def flush(corpus: Counter, toxic: Counter, clean: Counter) -> Iterator[pa.RecordBatch]:
        words = list(corpus)
        for at in range(0, len(words), 50_000):
            part = words[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), *(pa.array([c[w] for w in part], type=pa.int64()) for c in (corpus, toxic, clean))],
                names=["token", "n", "n_toxic", "n_clean"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, toxic, clean = Counter(), Counter(), Counter()
        labels = sample.value
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                words = _tokens(raw)
                corpus.update(words)
                label = labels.get(doc_id)
                if label is not None:
                    (toxic if label else clean).update(words)
            if len(corpus) > 400_000:
                yield from flush(corpus, toxic, clean)
                corpus, toxic, clean = Counter(), Counter(), Counter()
        yield from flush(corpus, toxic, clean)

    return run


def log_odds(counts: DataFrame, prior: float = PRIOR, least_z: float = LEAST_Z) -> DataFrame:
    """token, weight of the tokens that are clearly more frequent in toxic texts.

    The log-odds of the two classes with a Dirichlet prior in proportion to the corpus, over
    their standard error. Only tokens of toxic sample texts come back.
    """
    totals = counts.agg(F.sum("n").alias("t"), F.sum("n_toxic").alias("t1"), F.sum("n_clean").alias("t0"))
    total = totals.first()
    seen = counts.where("n_toxic >= 2")
    alpha = F.lit(prior) * F.col("n") / F.lit(total["t"] or 1)
    one, zero = F.col("n_toxic") + alpha, F.col("n_clean") + alpha
    t1, t0 = (F.lit((total[k] or 0) + prior) for k in ("t1", "t0"))
    delta = F.log(one / (t1 - one)) - F.log(zero / (t0 - zero))
    z = delta / F.sqrt(1 / one + 1 / zero)
    return seen.select("token", delta.alias("weight"), z.alias("z")).where(F.col("z") >= least_z)


class Scorer:
    """Scores of tokens by the model."""

    def __init__(self, weights: dict[str, float], cost: float = COST):
        self.weights, self.cost, self.memo = weights, cost, {}

    def __call__(self, word: str) -> float:
        score = self.memo.get(word)
        if score is None:
            if len(self.memo) > 300_000:
                self.memo.clear()
            score = self.weights.get(word)
            if score is None:
                score = next(
                    (self.weights[k] for n in BEGINNINGS if len(word) >= n and (k := word[:n] + "*") in self.weights), 0.0
                )
            score = self.memo[word] = score - self.cost
        return score


def _passages(text: bytes, scorer: Scorer) -> tuple[int, list[tuple[int, int, float]]]:
    scores = [scorer(w) for w in _tokens(text)]
    return len(scores), segments(scores) if scores and max(scores) > 0 else []


def fit_rate(positive: np.ndarray, words: int, cost: float = COST) -> float:
    """The rate of the extreme-value law: the root of mean(exp(rate * score)) = 1 over the words of clean texts.

    ``positive`` holds the scores above 0 among them, the others cost ``cost``.
    """
    low, high = 1e-6, 50.0
    rest = max(0, words - len(positive))
    for _ in range(100):
        rate = (low + high) / 2
        mean = np.exp(np.minimum(rate * positive, 500)).sum() + rest * math.exp(-rate * cost)
        low, high = (rate, high) if mean < max(words, 1) else (low, rate)
    return low


def evidence(n: int, scores: list[float], rate: float) -> float:
    """The largest -log10, over k, of the chance that k passages score as the k best do (the r-th extreme's law)."""
    most = 0.0
    for k, score in enumerate(sorted(scores, reverse=True), 1):
        expected = math.log10(max(n, 1) * SPREAD) - rate * score / math.log(10)
        if expected >= math.log10(k):
            break  # as many are expected by chance, and more of the weaker ones
        most = max(most, math.lgamma(k + 1) / math.log(10) - k * expected)
    return min(MOST_EVIDENCE, most)


def fit_logistic(x: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of the label on the evidence, with a small ridge; prior odds if one class is missing."""
    a, b = 0.0, 0.0
    if not len(x):
        return -3.0, 1.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-(a + b * x)))
        w = np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([(toxic - p).sum() - 0.01 * a, ((toxic - p) * x).sum() - 0.01 * b])
        hessian = np.array([[w.sum() + 0.01, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 0.01]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a + float(np.clip(step[0], -2, 2)), b + float(np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-8:
            break
    return a, b


class Model:
    """What fit() learned: weights of tokens, the rate of chance passages, the logistic curve."""

    def __init__(self, weights: dict[str, float], rate: float = 1.0, curve: tuple[float, float] = (-3.0, 1.0)):
        self.weights, self.rate, self.curve = weights, rate, curve

    def score(self, n: int, scores: list[float]) -> float:
        x = evidence(n, scores, self.rate)
        return 1 / (1 + math.exp(-(self.curve[0] + self.curve[1] * x)))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from a bounded sample of the labelled rows outside the held-out fold, and all texts' counts."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    known = known.where("doc_id is not null and toxic is not null")
    known = known.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = spark.sparkContext.broadcast({row["doc_id"]: row["toxic"] for row in sample.collect()})
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    counts = map_arrow(texts, _counts(sample), "token string, n long, n_toxic long, n_clean long")
    counts = counts.groupBy("token").agg(*(F.sum(c).alias(c) for c in ("n", "n_toxic", "n_clean")))
    # Beginnings stand for their words; both kinds are counted in one table, told apart by the star.
    parts = F.array(
        "token", *(F.when(F.length("token") >= n, F.concat(F.left("token", F.lit(n)), F.lit("*"))) for n in BEGINNINGS)
    )
    counts = counts.select(F.explode(parts).alias("token"), "n", "n_toxic", "n_clean").where("token is not null")
    counts = materialize(counts.groupBy("token").agg(*(F.sum(c).alias(c) for c in ("n", "n_toxic", "n_clean"))))
    weights = {row["token"]: row["weight"] for row in log_odds(counts).collect()}
    model = Model(weights)
    shared = spark.sparkContext.broadcast(weights)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, labelled = Scorer(shared.value), sample.value
        for batch in batches:
            rows = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                if doc_id in labelled:
                    n, found = _passages(raw, scorer)
                    above = [] if labelled[doc_id] else [x for x in map(scorer, _tokens(raw)) if x > 0]
                    rows.append((labelled[doc_id], n, [s for _, _, s in found], above))
            columns = list(zip(*rows)) or [(), (), (), ()]
            types = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types)], names=["toxic", "n", "scores", "above"]
            )

    # As many rows as the sample has; of each its passages and its words that count as toxic.
    rows = map_arrow(texts, best, "toxic int, n long, scores array<double>, above array<double>").collect()
    toxic = np.array([r["toxic"] for r in rows], dtype=float)
    above = [x for r in rows for x in r["above"]]
    # One more, as toxic words do stand in clean texts now and then.
    above.append(float(np.median(list(weights.values()))) - COST if weights else 1.0)
    model.rate = fit_rate(np.array(above), sum(r["n"] for r in rows if not r["toxic"]))
    x = np.array([evidence(r["n"], r["scores"], model.rate) for r in rows])
    model.curve = fit_logistic(x, toxic)
    return model


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, passages (first and last word, log-odds) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value.weights)
        for batch in batches:
            scores, found = [], []
            for raw in utf8(batch.column(1)):
                n, own = _passages(raw, scorer)
                scores.append(shared.value.score(n, [s for _, _, s in own]))
                found.append([{"first": a, "last": b - 1, "weight": s} for a, b, s in own])
            kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("weight", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, type=pa.float64()), pa.array(found, type=kind)],
                names=["doc_id", "score", "passages"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return map_arrow(
        texts, run, "doc_id long, score double, passages array<struct<first:bigint,last:bigint,weight:double>>"
    )


def score(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted, passages of every row.

    Null and empty texts have no passages and the score of that. Labels that contradict one
    another for an id count as toxic; without labels every text scores low. Rows with a null id
    are scored, but never learned from nor held out. Repeated rows are scored each.
    """
    scored = passages(docs, fit(docs, labels, sample_rows))
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0
    return scored.select(
        "doc_id",
        F.coalesce(out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "passages",
    )
