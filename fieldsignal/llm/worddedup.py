"""Removal of passages of words that stand anywhere else, by full-text indexes of bounded shards.

A window of WINDOW words belongs to the bucket of the least gram hash inside it, so equal windows
meet in one bucket wherever they stand; neighbouring starts of a text with the same bucket make a
run. Buckets with one run hold no repeated window. The runs of the others are streamed with their
words into shards of whole buckets; each shard is a compressed index, in which backward search finds
the longest matches of its runs, and windows that count twice or more are reported. So every window
is looked up in the one shard that can hold it, and hashes only choose that shard: what is removed
is decided by comparing words.

Equal runs of a task enter the index once, with their number, and share what is found. A bucket with
very many different runs (a common line in ever other surroundings) is dealt on by single windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldsignal.llm.common import longs, map_arrow, utf8
from fieldsignal.llm.fmindex import FMIndex, repeated
from fieldsignal.session import materialize

WINDOW, GRAM = 35, 12
#: Bytes of texts that a task takes up at once, of runs that it compares, and of the runs of a shard.
CHUNK_BYTES, HELD_BYTES, SHARD_BYTES = 3 << 20, 24 << 20, 3 << 20
#: Different runs of a bucket beyond which its windows are dealt singly.
HOT_RUNS = 2_000
#: Starts of a run at most: periodic text has one bucket throughout.
RUN_STARTS = 256
#: Stands for a null id.
NO_ID = -(1 << 63)

_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
FIRST, MORE, KNOWN = 0, 1, 2  # kinds of runs


class WordHashes(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = made = xxhash.xxh64_intdigest(word)
        return made


def gram_hashes(words: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM words from each place."""
    n = max(0, len(words) - GRAM + 1)
    h = words[:n] * _MIX[0]
    for j in range(1, GRAM):
        h += words[j : j + n]
        h *= _MIX[0]
    h ^= h >> np.uint64(32)
    h *= _MIX[1]
    return h ^ (h >> np.uint64(29))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def runs_of(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """bucket, content, start, size, periodic of the runs of texts whose word hashes lie end to end.

    A run can repeat one of its own windows only if its bucket's gram stands twice in it: periodic.
    """
    if len(words) < WINDOW:
        return (np.zeros(0, dtype=np.int64),) * 5
    h = gram_hashes(words)
    least = _least(h, WINDOW - GRAM + 1)
    end = np.repeat(ends, np.diff(np.r_[0, ends]))[: len(least)]
    change = (least[1:] != least[:-1]) | (end[1:] != end[:-1])
    start = np.r_[0, np.flatnonzero(change) + 1]
    stop = np.minimum(np.r_[start[1:], len(least)], end[start] - WINDOW + 1)
    start, stop = start[stop > start], stop[stop > start]
    pieces = -(-(stop - start) // RUN_STARTS)
    which = np.repeat(np.arange(len(start)), pieces)
    number = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start, stop = start[which] + number * RUN_STARTS, np.minimum(stop[which], start[which] + (number + 1) * RUN_STARTS)
    size = stop - start
    # Counts different runs of a bucket, and decides nothing else.
    content = h[start] * _MIX[0] + size.astype(np.uint64)
    last = stop - 1 + WINDOW - GRAM
    for j in range(GRAM, int(size.max(initial=0)) + WINDOW, GRAM):
        content = (content ^ (content >> np.uint64(31))) * _MIX[1] + h[np.minimum(start + j, last)]
    grams = size + WINDOW - GRAM
    head = np.cumsum(grams) - grams
    place = np.arange(int(grams.sum())) + np.repeat(start - head, grams)
    same = h[place] == np.repeat(least[start], grams)
    periodic = np.add.reduceat(same, head, dtype=np.int64) > 1 if len(head) else same
    return least[start].view(np.int64), content.view(np.int64), start, size, periodic


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    docs, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            docs.append(NO_ID if doc is None else doc)
            texts.append(text)
            size += len(text)
            if size > CHUNK_BYTES:
                yield np.array(docs, dtype=np.int64), texts
                docs, texts, size = [], [], 0
    if texts:
        yield np.array(docs, dtype=np.int64), texts


def _tag(text: bytes) -> int:
    return zlib.crc32(text) & 0x7FFFFFFF


class _Seen:
    """The keys that a task has met, bounded by its partition; few sorted arrays that grow by merging."""

    def __init__(self):
        self.parts: list[np.ndarray] = []

    def known(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), dtype=bool)
        for part in self.parts:
            at = np.minimum(np.searchsorted(part, keys), len(part) - 1)
            out |= part[at] == keys
        return out

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.parts.append(np.sort(keys))
        while len(self.parts) > 1 and len(self.parts[-2]) < 2 * len(self.parts[-1]):
            self.parts[-2:] = [np.sort(np.concatenate(self.parts[-2:]))]


RUNS = "route long, content long, doc long, pos long, size int, kind int"


def _find_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first run of each bucket in a task goes to the bucket; later ones are known to have company.

    MORE says so to the first one, once for each different run beyond it.
    """
    memo, keys, pairs, told = WordHashes(), _Seen(), _Seen(), _Seen()
    for docs, texts in _chunks(batches):
        found = [x.split() for x in texts]
        sizes = np.array([len(x) for x in found], dtype=np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1])
        hashes = np.fromiter(map(memo.__getitem__, chain.from_iterable(found)), dtype=np.uint64, count=total)
        key, content, start, size, periodic = runs_of(hashes, ends)
        if not len(key):
            continue
        owner = np.searchsorted(ends, start, side="right")
        tags = np.array([_tag(x) for x in texts], dtype=np.int64)
        doc, pos = docs[owner], (tags[owner] << 32) + start - (ends - sizes)[owner]
        _, at = np.unique(key, return_index=True)
        at = at[~keys.known(key[at])]
        first = np.zeros(len(key), dtype=bool)
        first[at] = True
        pair = key * 31 + content
        _, new = np.unique(pair, return_index=True)
        new = new[~pairs.known(pair[new])]
        keys.add(key[at])
        pairs.add(pair[new])
        more = new[~first[new]]
        # One equal run is enough to tell the first one that it is not alone.
        rest = np.flatnonzero(~first)
        tell = np.flatnonzero(~first | periodic)
        again, where = np.unique(key[tell], return_index=True)
        fresh = ~told.known(again)
        told.add(again[fresh])
        fresh &= ~np.isin(again, key[more])
        again, where = again[fresh], tell[where[fresh]]
        none = np.zeros(len(more) + len(again), dtype=np.int64)
        columns = [
            np.r_[key[at], key[more], again, doc[rest] * 1_000_003 ^ pos[rest] * 7_919],
            np.r_[content[at], content[more], content[where], key[rest]],
            np.r_[doc[at], none, doc[rest]],
            np.r_[pos[at], none, pos[rest]],
        ]
        numbers = [
            np.r_[size[at], none, size[rest]].astype(np.int32),
            np.repeat([FIRST, MORE, KNOWN], [len(at), len(none), len(rest)]).astype(np.int32),
        ]
        for k in range(0, len(columns[0]), 50_000):
            part = slice(k, k + 50_000)
            yield pa.RecordBatch.from_arrays(
                [*(longs(c[part]) for c in columns), *(pa.array(c[part]) for c in numbers)],
                names=["route", "content", "doc", "pos", "size", "kind"],
            )


PACKED = "doc long, tag long, packed binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = utf8(batch.column(1))
        docs = [NO_ID if x is None else x for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [longs(docs), longs([_tag(x) for x in texts]), pa.array([pack.compress(x) for x in texts], type=pa.binary())],
            names=["doc", "tag", "packed"],
        )


CUT = "bucket long, doc long, pos long, size int, copies long, words binary, of_doc long, of_pos long"


class _Held:
    """Equal runs of a task: the first one stands for all."""

    def __init__(self):
        self.known: dict[bytes, list] = {}
        self.copies: list[tuple[int, int, int, int]] = []
        self.bytes = 0

    def add(self, bucket: int, doc: int, pos: int, size: int, words: bytes) -> None:
        row = self.known.get(words)
        if row is None:
            self.known[words] = [bucket, doc, pos, size, 1]
            self.bytes += len(words) + 300
            return
        row[4] += 1
        if (row[1], row[2]) != (doc, pos):
            self.copies.append((doc, pos, row[1], row[2]))
            self.bytes += 150

    def rows(self) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        names = [x.split()[0] for x in CUT.split(", ")]
        rows = [(*row, words, None, None) for words, row in self.known.items()]
        rows += [(None, doc, pos, None, None, None, a, b) for doc, pos, a, b in self.copies]
        for at in range(0, len(rows), 10_000):
            columns = zip(*rows[at : at + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds)], names=names)
        self.known, self.copies, self.bytes = {}, [], 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the runs that have company; windows of hot buckets singly."""
    unpack, held = zstandard.ZstdDecompressor(), _Held()
    for batch in batches:
        for doc, packed, runs in zip(*(batch.column(n).to_pylist() for n in ("doc", "packed", "runs"))):
            words = unpack.decompress(packed).split()
            for run in runs:
                pos, size = run["pos"], run["size"]
                at = pos & 0xFFFFFFFF
                if not run["hot"]:
                    held.add(run["bucket"], doc, pos, size, b" ".join(words[at : at + size + WINDOW - 1]))
                else:
                    for k in range(size):
                        window = b" ".join(words[at + k : at + k + WINDOW])
                        held.add(xxhash.xxh64_intdigest(window) >> 1, doc, pos + k, 1, window)
                if held.bytes > HELD_BYTES:
                    yield from held.rows()
    yield from held.rows()


def search_shard(runs: list[bytes], copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """run, first, size: starts of windows that stand twice or more in the runs, each of which counts ``copies`` times."""
    numbers: dict[bytes, int] = {}
    symbols: list[int] = []
    ends = []
    for run in runs:
        symbols.extend([numbers.setdefault(w, len(numbers) + 1) for w in run.split(b" ")])
        ends.append(len(symbols))
        symbols.append(0)
    text, ends = np.array(symbols, dtype=np.int64), np.array(ends, dtype=np.int64)
    begins = np.r_[0, ends[:-1] + 1]
    index = FMIndex(text, copies)
    from_, to = repeated(index, text, begins, ends - WINDOW, WINDOW)
    run = np.searchsorted(ends, from_)
    return run, from_ - begins[run], to - from_ + 1


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards of whole buckets, each indexed and searched by itself."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        words = rows.column("words").to_pylist()
        fresh = np.array([True, *(a != b for a, b in zip(words[1:], words))])
        number = np.cumsum(fresh) - 1
        head = np.flatnonzero(fresh)
        copies = np.add.reduceat(rows.column("copies").to_numpy(), head)
        run, first, size = search_shard([words[k] for k in head.tolist()], copies)
        order = np.argsort(run, kind="stable")
        run, first, size = run[order], first[order], size[order]
        # What is found for a run holds for every row with its words.
        low, high = np.searchsorted(run, number), np.searchsorted(run, number, side="right")
        row = np.repeat(np.arange(len(number)), high - low)
        at = np.arange(len(row)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[row]
        doc, pos = rows.column("doc").to_numpy()[row], rows.column("pos").to_numpy()[row]
        return pa.RecordBatch.from_arrays(
            [longs(doc), longs(pos), longs(first[at]), longs(size[at])], names=["doc", "pos", "first", "size"]
        )

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > SHARD_BYTES:
            rows = pa.Table.from_batches(held)
            buckets = rows.column("bucket").to_numpy()
            cut = int(np.searchsorted(buckets, buckets[-1]))  # the last bucket may go on
            if cut:
                yield solve(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
                size = sum(x.nbytes for x in held)
    if sum(x.num_rows for x in held):
        yield solve(pa.Table.from_batches(held))


def repeated_starts(docs: DataFrame, hot_runs: int = HOT_RUNS) -> DataFrame:
    """doc, tag, starts: where repeated windows start in each text that has any.

    A text is named by its id (NO_ID for null) and a checksum; ``starts`` holds runs of starts,
    each as start * 2^31 + number.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    runs = map_arrow(texts, _find_runs, RUNS).withColumn("known", F.col("kind") == KNOWN)
    bucket = Window.partitionBy("route", "known")
    runs = runs.withColumn("different", F.dense_rank().over(bucket.orderBy("content")))
    runs = runs.withColumn("rows", F.count("*").over(bucket)).withColumn("different", F.max("different").over(bucket))
    company = (F.col("kind") == FIRST) & (F.col("rows") > 1)
    marks = materialize(
        runs.where(F.col("known") | company).select(
            F.when(F.col("known"), F.col("content")).otherwise(F.col("route")).alias("bucket"),
            "doc", "pos", "size", (~F.col("known") & (F.col("different") > hot_runs)).alias("hot"),
        )
    )
    hot = marks.where("hot").select("bucket", F.lit(True).alias("hot")).distinct()
    run = F.struct("pos", "bucket", "size", F.coalesce("hot", F.lit(False)).alias("hot"))
    held = marks.drop("hot").join(hot, "bucket", "left")
    held = held.groupBy("doc", F.shiftright("pos", 32).alias("tag")).agg(F.collect_set(run).alias("runs"))
    packed = map_arrow(texts, _pack, PACKED).join(held, ["doc", "tag"])
    cut = materialize(map_arrow(packed.select("doc", "packed", "runs"), _cut, CUT))
    shards = cut.where("words IS NOT NULL").select("bucket", "doc", "pos", "copies", "words")
    shards = shards.repartition("bucket").sortWithinPartitions("bucket", "words")
    found = materialize(map_arrow(shards, _search, "doc long, pos long, first long, size long"))
    copies = cut.where("words IS NULL").select(F.col("doc").alias("own"), F.col("pos").alias("at"), "of_doc", "of_pos")
    shared = found.join(copies, (found["doc"] == copies["of_doc"]) & (found["pos"] == copies["of_pos"]))
    every = found.union(shared.select("own", "at", "first", "size"))
    start = (F.col("pos").bitwiseAND(0xFFFFFFFF) + F.col("first")) * F.lit(1 << 31) + F.col("size")
    return every.groupBy("doc", F.shiftright("pos", 32).alias("tag")).agg(F.collect_set(start).alias("starts"))


def spans(starts: list[int] | None) -> list[tuple[int, int]]:
    """The maximal removed runs of words (first, behind the last), from runs of starts."""
    out: list[tuple[int, int]] = []
    for x in sorted(starts or ()):
        at, stop = x >> 31, (x >> 31) + (x & 0x7FFFFFFF) - 1 + WINDOW
        if out and at <= out[-1][1]:
            out[-1] = out[-1][0], max(stop, out[-1][1])
        else:
            out.append((at, stop))
    return out


KEPT = "doc_id long, n_words long, n_removed long, spans array<struct<first:bigint,last:bigint>>, kept string"


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    types = [pa.int64(), pa.int64(), pa.int64(), span, pa.string()]
    for batch in batches:
        rows = []
        for doc, packed, starts in zip(*(batch.column(n).to_pylist() for n in ("doc", "packed", "starts"))):
            words, removed = unpack.decompress(packed).split(), spans(starts)
            edges = [0, *(x for a_b in removed for x in a_b), len(words)]
            kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
            rows.append((
                None if doc == NO_ID else doc, len(words), len(words) - len(kept),
                [{"first": a, "last": b - 1} for a, b in removed], b" ".join(kept).decode(),
            ))
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, type=t) for c, t in zip(columns, types)],
            names=["doc_id", "n_words", "n_removed", "spans", "kept"],
        )


def remove_repeated(docs: DataFrame, hot_runs: int = HOT_RUNS) -> DataFrame:
    """doc_id, n_words, n_removed, spans (first and last word), kept (words joined by spaces) of every row.

    A word goes if a window of WINDOW words covers it that also starts anywhere else. A null text
    has no words, a null id is an id like others. Repeated rows are texts of their own, hence repeat
    each other. Only doc_id and text of docs are read; an empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    found = map_arrow(texts, _pack, PACKED).join(repeated_starts(docs, hot_runs), ["doc", "tag"], "left")
    return map_arrow(found.select("doc", "packed", "starts"), _kept, KEPT)
