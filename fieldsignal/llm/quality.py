"""Quality rules: fixed heuristics, and a hashed n-gram likelihood ratio against a trusted sample.

Words and signs of a text, single and in pairs, are hashed into BUCKETS bins. Two multinomials
over the bins, of the trusted texts and of the raw corpus, give each text the mean logarithm of
their ratio over its n-grams. The trusted one has a Dirichlet prior of the raw one, so that thin
evidence rejects nothing. Texts below a fixed threshold are rejected, whatever else comes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldsignal.llm.common import longs, map_arrow, utf8

BUCKETS = 1 << 16
#: Trusted texts that are learned from at most.
TRUSTED_ROWS = 20_000
#: The least mean log-likelihood ratio of an n-gram, in nats, of a text that is kept.
THRESHOLD = -0.35
#: Share of the raw multinomial in the trusted one, which bounds what an unseen n-gram can weigh.
SMOOTHING = 0.01
#: Pseudo-counts of the trusted multinomial, dealt out as the raw one: one for each bin on average.
PRIOR = BUCKETS
SYMBOLS = b"#*$%&|<>"
_PARTS = re.compile(r"\w+|[^\w\s]+").findall
_NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
_SPACES = b" \t\n\r\x0b\x0c"


class Bins(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = made = xxhash.xxh32_intdigest(word)
        return made


def bins(text: str, memo: Bins) -> np.ndarray:
    """The bins of the single parts and of the pairs of a text."""
    parts = np.array([memo[x] for x in _PARTS(text)], dtype=np.uint64)
    pairs = (parts[:-1] * np.uint64(0x9E3779B1) ^ parts[1:]) * np.uint64(0x85EBCA77) >> np.uint64(13)
    return np.concatenate([parts, pairs]).astype(np.int64) & (BUCKETS - 1)


def heuristics(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    letters = b"".join(words)
    chars = len(letters) if letters.isascii() else len(letters.decode())
    symbols = len(text.translate(None, _NOT_SYMBOLS))
    copies, seen = 0, set()
    for line in text.split(b"\n"):
        if line.strip(_SPACES):
            copies += line in seen
            seen.add(line)
    repeated = 0
    if len(words) > 3:
        numbers: dict[bytes, int] = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
        n = len(numbers)
        if n < 1 << 21:
            windows = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
        else:
            _, pairs = np.unique(ids[:-2] * n + ids[1:-1], return_inverse=True)
            windows = pairs * n + ids[2:]
        order = np.argsort(windows, kind="stable")
        same = windows[order[1:]] == windows[order[:-1]]
        if same.any():
            twice = np.zeros(len(windows), dtype=bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            covered = np.zeros(len(words), dtype=bool)
            for k in range(3):
                covered[k : k + len(windows)] |= twice
            repeated = int(covered.sum())
    return len(words), chars, symbols, copies, repeated


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def corpus_bins(docs: DataFrame, trusted: DataFrame, sample_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each bin stands in the trusted texts and in all: one pass, no text leaves its task.

    Partial counts of a task are summed, BUCKETS at most come back.
    """
    spark = docs.sparkSession
    ids = trusted.select(F.col("doc_id").cast("long")).where("doc_id is not null").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    known = spark.sparkContext.broadcast({row["doc_id"] for row in ids.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, memo = np.zeros((2, BUCKETS), dtype=np.int64), Bins()
        for batch in batches:
            held: tuple[list, list] = [], []
            for doc_id, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                held[doc_id not in known.value].append(bins(raw.decode(), memo))
            for k in (0, 1):
                if held[k]:
                    total[k] += np.bincount(np.concatenate(held[k]), minlength=BUCKETS)
        total[1] += total[0]
        found = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays(
            [longs(found), longs(total[0, found]), longs(total[1, found])], names=["bin", "n_trusted", "n"]
        )

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    counted = map_arrow(texts, run, "bin long, n_trusted long, n long").groupBy("bin")
    out = np.zeros((2, BUCKETS), dtype=np.int64)
    for row in counted.agg(F.sum("n_trusted").alias("n_trusted"), F.sum("n").alias("n")).collect():
        out[:, row["bin"]] = row["n_trusted"], row["n"]
    return out[0], out[1]


def ratios(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed multinomials by bin; 0 throughout if there is nothing to compare."""
    if not trusted.sum() or not raw.sum():
        return np.zeros(len(raw))
    q = (raw + 1) / (raw.sum() + len(raw))
    p = (1 - SMOOTHING) * (trusted + PRIOR * q) / (trusted.sum() + PRIOR) + SMOOTHING * q
    return np.log(p / q)


JUDGED = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, llr double, kept boolean"
)


def _judge(weights, threshold: float, at: int, keep_rows: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Bins()
        for batch in batches:
            rows = []
            for raw in utf8(batch.column(at)):
                made = heuristics(raw)
                failed = base_failed(made[0], made[4])
                found = bins(raw.decode(), memo)
                mean = float(weights.value[found].mean()) if len(found) else 0.0
                rows.append((*made, failed, mean, not failed and mean >= threshold))
            columns = list(zip(*rows)) or [()] * 8
            if keep_rows:
                yield batch.filter(pa.array(columns[7], type=pa.bool_()))
                continue
            types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            names = [x.split()[0] for x in JUDGED.split(",")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, type=t) for c, t in zip(columns, types))], names=["doc_id", *names]
            )

    return run


def _weights(docs: DataFrame, trusted: DataFrame, sample_rows: int):
    """The bins' log ratios: all texts of docs against those whose ids are trusted."""
    return docs.sparkSession.sparkContext.broadcast(ratios(*corpus_bins(docs, trusted, sample_rows)))


def judge(
    docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, sample_rows: int = TRUSTED_ROWS
) -> DataFrame:
    """doc_id, the heuristics, base_failed, llr, kept of every row.

    ``trusted`` holds the doc_id of texts of good quality, of which ``sample_rows`` at most are
    learned from: those whose ids hash lowest. All texts count for the raw corpus. Without trusted
    texts every ratio is 0, and the heuristics decide alone; with very few, as in a corpus of 200
    texts, no text differs enough from the raw corpus to be rejected. A null text has no words and
    fails; repeated rows are judged each.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return map_arrow(texts, _judge(_weights(docs, trusted, sample_rows), threshold, 1, False), f"doc_id long, {JUDGED}")


def keep_good(
    docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, sample_rows: int = TRUSTED_ROWS
) -> DataFrame:
    """The rows of docs, all columns, that are kept; see ``judge`` for null, empty and repeated ones."""
    at = docs.columns.index("text")
    return map_arrow(docs, _judge(_weights(docs, trusted, sample_rows), threshold, at, True), docs.schema)
