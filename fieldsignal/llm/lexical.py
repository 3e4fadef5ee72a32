"""Ranked lexical search: an Aho-Corasick scan of whole texts for the terms of all queried items.

The terms of a block of items form an automaton. Each term stands in it between two separators, and
texts are read with every separator as a space, so only whole terms match; what the automaton puts
out are numbers of terms, and a table beside it maps these to items. Term frequencies come straight
from the text: no index of the documents is built, and nothing of a text leaves its task. One scan
counts documents, terms and document frequencies, a second one scores.

Items are dealt into blocks of bounded size, each with its own automaton and its own two scans, so
what is broadcast does not grow with the table of items. A task hands on the best documents of each
item; these meet by item and salt first, then by item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldsignal.llm.common import LOWER, UPPER, WORD_BYTES, longs, map_arrow, utf8

TOP = 50
#: Items and bytes of terms of a block at most; an item whose terms are longer is a block of its own.
BLOCK_ITEMS, BLOCK_BYTES = 1_000, 4 << 20
#: Documents that are scored at once.
SCORED_ROWS = 250


class Terms:
    """The terms of a block of items, and the items that hold each of them."""

    def __init__(self, items: list[tuple[int, list[bytes]]]):
        self.items = [name for name, _ in items]
        numbers: dict[bytes, int] = {}
        held: list[list[int]] = []
        for at, (_, terms) in enumerate(items):
            for term in set(terms):
                number = numbers.setdefault(term, len(numbers))
                if number == len(held):
                    held.append([])
                held[number].append(at)
        self.terms = list(numbers)
        self.ends = np.cumsum([len(x) for x in held], dtype=np.int64)
        self.held = np.array([x for found in held for x in found], dtype=np.int64)

    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            made.add_word(f" {term.decode('latin-1')} ", number)
        made.make_automaton()
        return made


_number = itemgetter(1)


class Scanner:
    """Counts of a text: all its terms, and how often each searched one stands in it."""

    def __init__(self, terms: Terms):
        self.found = terms.automaton().iter if terms.terms else None

    def __call__(self, raw: bytes) -> tuple[int, Counter]:
        text = b" %b " % raw.translate(WORD_BYTES)
        n = len(text.split())
        if not n or self.found is None:
            return n, Counter()
        return n, Counter(map(_number, self.found(text.decode("latin-1"))))


def blocks(items: DataFrame) -> Iterator[Terms]:
    """The items with their distinct terms, block by block; one block at a time is on the driver.

    Rows of one id are one item with the terms of all of them.
    """
    words = F.split(F.translate("text", UPPER, LOWER), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    terms = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode_outer(words).alias("term"))
    known = terms.groupBy("item_id").agg(F.array_remove(F.collect_set("term"), "").alias("terms"))
    rows, size = [], 0
    for row in known.toLocalIterator():
        found = [x.encode() for x in row["terms"]]
        rows.append((row["item_id"], found))
        size += sum(map(len, found))
        if len(rows) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield Terms(rows)
            rows, size = [], 0
    if rows:
        yield Terms(rows)


def count(docs: DataFrame, shared) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms with repeats, and of each searched term its document frequency."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(shared.value)
        frequency, n_docs, n_terms = np.zeros(len(shared.value.terms), dtype=np.int64), 0, 0
        for batch in batches:
            for raw in utf8(batch.column(0)):
                n, found = scan(raw)
                n_docs += n > 0
                n_terms += n
                if found:
                    frequency[np.fromiter(found, dtype=np.int64, count=len(found))] += 1
        at = np.flatnonzero(frequency)
        yield pa.RecordBatch.from_arrays(
            [longs(np.r_[at, -1, -2]), longs(np.r_[frequency[at], n_docs, n_terms])], names=["term", "n"]
        )

    # As many rows as the block has terms, and two.
    counted = map_arrow(docs.select("text"), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    totals = {r["term"]: r["n"] for r in counted.collect()}
    frequency = np.zeros(len(shared.value.terms), dtype=np.int64)
    for term, n in totals.items():
        if term >= 0:
            frequency[term] = n
    return totals.get(-1, 0), totals.get(-2, 0), frequency


def weights(n_docs: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in frequency.tolist()], dtype=np.int64)


class Best:
    """The best documents of each item so far."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.bar = np.zeros(items, dtype=np.int64)  # scores up to here are out, unless ids decide
        self.item = self.score = np.zeros(0, dtype=np.int64)
        self.doc: list = []
        self.new: list[tuple[np.ndarray, np.ndarray, list]] = []
        self.waiting = 0

    def add(self, scores: np.ndarray, docs: list) -> None:
        """Scores by item and document."""
        item, at = np.nonzero((scores > 0) & (scores >= self.bar[:, None]))
        self.new.append((item, scores[item, at], [docs[x] for x in at.tolist()]))
        self.waiting += len(item)
        if self.waiting > 100_000:
            self.cut()

    def cut(self) -> None:
        item = np.concatenate([self.item, *(x[0] for x in self.new)])
        score = np.concatenate([self.score, *(x[1] for x in self.new)])
        doc = [*self.doc, *(d for x in self.new for d in x[2])]
        ids = np.array([(0 if d is None else d) for d in doc], dtype=np.int64)
        known = np.array([d is not None for d in doc], dtype=bool)
        order = np.lexsort((ids, known, -score, item))
        sorted_ = item[order]
        head = np.searchsorted(sorted_, sorted_)
        order = order[np.arange(len(order)) - head < self.top]
        self.item, self.score, self.doc = item[order], score[order], [doc[x] for x in order.tolist()]
        full = np.flatnonzero(np.bincount(self.item, minlength=len(self.bar)) >= self.top)
        last = np.searchsorted(self.item, full, side="right") - 1
        self.bar[full] = self.score[last]
        self.new, self.waiting = [], 0


def _score(shared, n_docs: int, n_terms: int, weight, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        scan, w = Scanner(terms), weight.value
        first = np.r_[0, terms.ends[:-1]] if len(terms.ends) else terms.ends
        size = terms.ends - first
        best = Best(len(terms.items), top)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
            for start in range(0, len(ids), SCORED_ROWS):
                row, term, part = [], [], []
                for k, raw in enumerate(texts[start : start + SCORED_ROWS]):
                    n, found = scan(raw)
                    if not found:
                        continue
                    m = 20 * (50 + (50 * n * n_docs) // n_terms)
                    number = np.fromiter(found, dtype=np.int64, count=len(found))
                    tf = np.fromiter(found.values(), dtype=np.int64, count=len(found))
                    row.append(np.full(len(number), k))
                    term.append(number)
                    part.append(w[number] * ((1_000_000_000 * tf) // (1000 * tf + m)))
                if not row:
                    continue
                row, term, part = (np.concatenate(x) for x in (row, term, part))
                copies = size[term]
                at = np.repeat(first[term] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())
                docs = ids[start : start + SCORED_ROWS]
                cell = terms.held[at] * len(docs) + np.repeat(row, copies)
                scores = np.zeros(len(terms.items) * len(docs), dtype=np.int64)
                np.add.at(scores, cell, np.repeat(part, copies))
                best.add(scores.reshape(len(terms.items), -1), docs)
        best.cut()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([terms.items[x] for x in best.item.tolist()], type=pa.int64()),
                pa.array(best.doc, type=pa.int64()),
                longs(best.score),
            ],
            names=["item_id", "doc_id", "score"],
        )

    return run


def _ranked(scored: DataFrame, keys: list, top: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return scored.withColumn("rank", rank).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: of each item the ``top`` documents with the highest scores above 0.

    Null texts have no terms. Repeated rows are documents of their own: each counts in all
    statistics and can take a rank. Equal scores go by doc_id, null before all. Rows of one item_id
    are one item, null being an id like others. Items without terms and empty tables give no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    found = None
    for terms in blocks(items):
        shared = spark.sparkContext.broadcast(terms)
        n_docs, n_terms, frequency = count(texts, shared)
        if not n_terms:
            break
        weight = spark.sparkContext.broadcast(weights(n_docs, frequency))
        part = map_arrow(texts, _score(shared, n_docs, n_terms, weight, top), "item_id long, doc_id long, score long")
        # Partial results of all tasks would meet by item: the root of their number does so first.
        salts = max(1, math.isqrt(texts.rdd.getNumPartitions()))
        part = _ranked(part.withColumn("salt", F.spark_partition_id() % salts), ["item_id", "salt"], top)
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], "item_id long, doc_id long, score long, salt int, rank int")
    return _ranked(found.select("item_id", "doc_id", "score"), ["item_id"], top).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
    )
