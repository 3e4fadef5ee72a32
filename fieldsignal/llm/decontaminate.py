"""Decontamination against a benchmark by suffix arrays of the training texts.

The words of the benchmark are numbered; a shard of documents becomes one sequence of those
numbers, 0 for every other word. The shard's suffix array holds the suffixes that begin with a
run of words which stands somewhere in the benchmark; every benchmark suffix is looked up in it
by binary search, which gives its longest verbatim match and the places of its window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from fieldsignal.llm.common import WORD_BYTES, longs, map_arrow, utf8

WINDOW = 13
#: Bytes of training texts of a shard, and of benchmark texts that go to the tasks in one block.
SHARD_BYTES, BLOCK_BYTES = 6 << 20, 16 << 20
#: Texts for which a block is prepared once.
GROUP_BYTES = 32 << 20


class Benchmark:
    """The windows of a block of benchmark items, as word numbers."""

    def __init__(self, items: list[tuple[int, bytes]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        texts = [(name, x.translate(WORD_BYTES).split()) for name, x in items]
        texts = [(name, words) for name, words in texts if words]
        numbers = [np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in words]) for _, words in texts]
        self.names = [name for name, _ in texts]
        sizes = np.array([len(x) for x in numbers], dtype=np.int64)
        self.words = np.concatenate([*numbers, np.zeros(window, dtype=np.int64)]).astype(np.int32)
        self.ends = np.cumsum(sizes)
        self.shortest = int(min([window, *sizes])) if len(sizes) else 0
        starts, lengths, owners = [], [], []
        for k, (end, size) in enumerate(zip(self.ends, sizes)):
            count = max(1, size - window + 1)
            starts.append(end - size + np.arange(count))
            lengths.append(np.full(count, min(window, size)))
            owners.append(np.full(count, k))
        none = [np.zeros(0, dtype=np.int64)]
        self.starts, self.lengths, self.owners = (np.concatenate(x or none) for x in (starts, lengths, owners))


def suffix_array(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The starts in the order of the ``depth`` words from each; ``words`` is padded by ``depth``."""
    order = starts
    if not len(order):
        return order
    tied = np.zeros(len(order), dtype=np.int64)  # the rank of the group that is not yet told apart
    for at in range(0, depth, 2):
        key = words[order + at].astype(np.int64) << 32 | words[order + min(at + 1, depth - 1)].astype(np.int64)
        sort = np.lexsort((key, tied))
        order, tied, key = order[sort], tied[sort], key[sort]
        fresh = np.r_[True, (tied[1:] != tied[:-1]) | (key[1:] != key[:-1])]
        tied = np.cumsum(fresh)
    return order


def _bound(words, array, test, starts, depth, upper: bool) -> np.ndarray:
    """Binary search of the first ``depth`` test words from each start among the suffixes."""
    low, high = np.zeros(len(starts), dtype=np.int64), np.full(len(starts), len(array), dtype=np.int64)
    while True:
        active = np.flatnonzero(low < high)
        if not len(active):
            return low
        middle = (low[active] + high[active]) // 2
        less = np.zeros(len(active), dtype=bool)
        open_ = np.ones(len(active), dtype=bool)
        for k in range(int(depth.max())):
            open_ &= k < depth[active]
            if not open_.any():
                break
            mine, theirs = words[array[middle] + k], test[starts[active] + k]
            less |= open_ & (mine < theirs)
            open_ &= mine == theirs
        go = less | (open_ | (depth[active] == 0) if upper else False)
        # where all words agreed, the upper bound goes on and the lower one stops
        if upper:
            same = np.ones(len(active), dtype=bool)
            for k in range(int(depth.max())):
                same &= (k >= depth[active]) | (words[array[middle] + k] == test[starts[active] + k])
            go = less | same
        low[active] = np.where(go, middle + 1, low[active])
        high[active] = np.where(go, high[active], middle)


def look_up(words: np.ndarray, array: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, ...]:
    """Binary search of every benchmark suffix in the suffix array of a shard.

    Of every suffix in order: the words of its longest match and a place of it (-1: none). Then of
    every place of a window: the number of the window, and the place.
    """
    total = int(bench.ends[-1]) if len(bench.ends) else 0
    best, place = np.zeros(total, dtype=np.int64), np.full(total, -1, dtype=np.int64)
    none = np.zeros(0, dtype=np.int64)
    if not total or not len(array):
        return best, place, none, none
    starts = np.arange(total)
    left = bench.ends[np.searchsorted(bench.ends, starts, side="right")] - starts
    depth = np.minimum(left, WINDOW)
    lo = _bound(words, array, bench.words, starts, depth, False)
    # A match shorter than a window is longest with one of the two suffixes beside the bound.
    for near in (lo - 1, lo):
        known = np.flatnonzero((near >= 0) & (near < len(array)))
        where, size = array[near[known]], np.zeros(len(known), dtype=np.int64)
        open_ = np.arange(len(known))
        while len(open_):
            k = size[open_]
            same = (k < depth[known[open_]]) & (where[open_] + k < len(words))
            open_, k = open_[same], k[same]
            same = words[where[open_] + k] == bench.words[starts[known[open_]] + k]
            open_ = open_[same]
            size[open_] += 1
        better = size > best[known]
        best[known[better]], place[known[better]] = size[better], where[better]
    whole = np.flatnonzero(best[bench.starts] >= bench.lengths)
    if not len(whole):
        return best, place, none, none
    first = lo[bench.starts[whole]]
    count = _bound(words, array, bench.words, bench.starts[whole], bench.lengths[whole], True) - first
    which = np.repeat(whole, count)
    places = array[np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)]
    # Windows that follow one another in an item and in a document are one longer match.
    starts, owners = bench.starts[which], bench.owners[which]
    order = np.lexsort((starts, places - starts, owners))
    s, p, o = starts[order], places[order], owners[order]
    last = np.r_[(np.diff(s) != 1) | (np.diff(p) != 1) | (np.diff(o) != 0), True]
    end = np.flatnonzero(last)[np.searchsorted(np.flatnonzero(last), np.arange(len(s)))]
    size = s[end] - s + bench.lengths[which[order]]
    rank = np.lexsort((p, -size, s))
    top = rank[np.r_[True, np.diff(s[rank]) != 0]]
    best[s[top]], place[s[top]] = size[top], p[top]
    return best, place, which, places


def longest_matches(words: np.ndarray, array: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """Of every benchmark suffix in order: the words of its longest match in the shard, and where (-1: none)."""
    return look_up(words, array, bench)[:2]


def search(texts: list[bytes], bench: Benchmark):
    """Word counts, hit words, and (document, item) pairs of a shard, longest match and place of every
    benchmark suffix, and the word arrays behind them."""
    ids, pad = bench.ids, len(bench.words) and WINDOW
    found = [x.translate(WORD_BYTES).split() for x in texts]
    sizes = np.array([len(x) for x in found], dtype=np.int64)
    ends = np.cumsum(sizes + 1)  # a 0 stands between documents, so no match crosses them
    words = np.zeros(int(ends[-1]) + pad + 1 if len(ends) else 1, dtype=np.int32)
    for x, end, size in zip(found, ends, sizes):
        words[end - 1 - size : end - 1] = [ids.get(w, 0) for w in x]
    hits = np.zeros(len(words) + 1, dtype=np.int64)
    none = np.zeros(0, dtype=np.int64)
    if not len(bench.starts):
        return sizes, hits[: len(words)] > 0, ends, none, none, none, none, words, none
    # Suffixes whose first words, as many as the shortest window, stand nowhere in the benchmark match no window.
    size = min(bench.shortest, 4)
    admitted = words[: len(words) - pad] > 0
    mine, theirs = words[: len(words) - pad].astype(np.int64), bench.words[: len(bench.words) - WINDOW].astype(np.int64)
    scale = np.int64(len(ids) + 1)
    starts = np.flatnonzero(admitted)
    for k in range(1, size):
        # numbers of runs of k + 1 words of the benchmark; 0 where a run is none of them
        n = len(theirs)
        following = bench.words[k : k + n].astype(np.int64)
        runs = np.unique(theirs * scale + following)
        key = mine[starts] * scale + words[starts + k]
        at = np.minimum(np.searchsorted(runs, key), len(runs) - 1)
        good = (runs[at] == key) & (words[starts + k] > 0)
        starts = starts[good]
        mine[starts] = at[good] + 1
        theirs = np.searchsorted(runs, theirs * scale + following) + 1
        scale = np.int64(len(ids) + 1)
    array = suffix_array(words, starts, WINDOW)
    best, place, which, places = look_up(words, array, bench)
    np.add.at(hits, places, 1)
    np.add.at(hits, places + bench.lengths[which], -1)
    hits = np.cumsum(hits)[: len(words)] > 0
    docs = np.searchsorted(ends, places, side="right")
    return sizes, hits, ends, docs, bench.owners[which], best, place, words, array


FOUND = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def digest(names: set) -> str:
    return hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest()


def contaminated(n_hit: int, n_words: int) -> bool:
    """The rule: a hit, and hits are one word in twenty or more."""
    return n_hit > 0 and 20 * n_hit >= n_words


def _shards(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows of at most SHARD_BYTES of text (or one longer text), with the texts of column ``at``."""
    held, texts, size = [], [], 0
    for batch in batches:
        lo = 0
        for k, text in enumerate(utf8(batch.column(at))):
            if texts and size + len(text) > SHARD_BYTES:
                yield pa.concat_batches([*held, batch.slice(lo, k - lo)]), texts
                held, texts, size, lo = [], [], 0, k
            texts.append(text)
            size += len(text)
        held.append(batch.slice(lo))
    if texts:
        yield pa.concat_batches(held), texts


def _rounds(blocks: list, batches: Iterator[pa.RecordBatch], at: int):
    """Groups of shards, with every shard and block of a group to be searched; one prepared block in memory at a time.

    A block is prepared once for GROUP_BYTES of texts; the next group goes through the blocks the
    other way round, so a single block is prepared once for a task.
    """
    state: dict = {"at": None, "bench": None, "back": False}

    def search_all(group):
        for k in reversed(range(len(blocks))) if state["back"] else range(len(blocks)):
            if state["at"] != k:
                state["bench"] = None  # the block before is let go first
                state["at"], state["bench"] = k, Benchmark(blocks[k].value)
            for shard, (_, texts) in enumerate(group):
                yield shard, texts, state["bench"]
        state["back"] = not state["back"]

    group, size = [], 0
    for shard in _shards(batches, at):
        group.append(shard)
        size += sum(map(len, shard[1]))
        if size > GROUP_BYTES:
            yield group, search_all(group)
            group, size = [], 0
    if group:
        yield group, search_all(group)


def _judged(blocks: list, batches: Iterator[pa.RecordBatch], at: int):
    """Of every shard: its rows, words, hit words and the items with windows in each text."""
    for group, steps in _rounds(blocks, batches, at):
        hit: list = [None] * len(group)
        counts: list = [None] * len(group)
        items: list[list[set]] = [[set() for _ in texts] for _, texts in group]
        for shard, texts, bench in steps:
            sizes, hits, ends, docs, owners, *_ = search(texts, bench)
            packed = np.packbits(hits[: int(ends[-1])])
            hit[shard] = packed if hit[shard] is None else hit[shard] | packed
            counts[shard] = (sizes, ends)
            for pair in np.unique(docs * max(1, len(bench.names)) + owners).tolist():
                doc, owner = divmod(pair, len(bench.names))
                items[shard][doc].add(bench.names[owner])
        for (rows, texts), packed, count, found in zip(group, hit, counts, items):
            if packed is None:
                n_words, n_hit = [len(x.translate(WORD_BYTES).split()) for x in texts], [0] * len(texts)
            else:
                sizes, ends = count
                total = np.r_[0, np.cumsum(np.unpackbits(packed)[: int(ends[-1])])]
                n_words, n_hit = sizes.tolist(), (total[ends] - total[ends - 1 - sizes]).tolist()
            yield rows, n_words, n_hit, found


def _find(blocks: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, n_words, n_hit, items in _judged(blocks, batches, 1):
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    longs(n_words),
                    longs(n_hit),
                    longs([len(x) for x in items]),
                    pa.array([digest(x) for x in items]),
                    pa.array([contaminated(a, b) for a, b in zip(n_hit, n_words)], type=pa.bool_()),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return run


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list:
    """The benchmark as broadcasts of at most ``block_bytes`` of text (or one longer item) each.

    A benchmark is a stated query set, searched in blocks against all rows; its rows are read one
    partition at a time.
    """
    context = benchmark.sparkSession.sparkContext
    blocks, held, size = [], [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        text = (row["text"] or "").encode()
        if held and size + len(text) > block_bytes:
            blocks.append(context.broadcast(held))
            held, size = [], 0
        held.append((row["item_id"], text))
        size += len(text)
    if held:
        blocks.append(context.broadcast(held))
    return blocks


def find_contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row.

    Null texts have no words. An item without words has no window; repeated items count once per
    id. Documents are judged each by itself, repeated rows too; no shuffle is needed.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return map_arrow(texts, _find(benchmark_blocks(benchmark, block_bytes)), FOUND)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, all columns, that are not contaminated."""
    blocks, at = benchmark_blocks(benchmark, block_bytes), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, n_words, n_hit, _ in _judged(blocks, batches, at):
            yield rows.filter(pa.array([not contaminated(a, b) for a, b in zip(n_hit, n_words)], type=pa.bool_()))

    return map_arrow(docs, run, docs.schema)


MATCH = ("start", "length", "doc_id", "place")


def longest_verbatim(
    docs: DataFrame, benchmark: DataFrame, min_words: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """item_id, start, length, doc_id, place: where every benchmark suffix stands longest in docs.

    start is the first word of the suffix in its item, length the words of the match, place its
    first word in the document; of equally long ones the smallest doc_id (null last), then place.
    Suffixes without a match of ``min_words`` (the whole item, if that is shorter) have no row. A
    shard hands on one row for a suffix and the maxima meet by suffix, pre-aggregated. Rows that
    repeat an item_id are searched each, and the longest match of a start is kept. Null texts match nothing.
    """
    if min_words < 4:
        raise ValueError("shards index suffixes by runs of four words")
    blocks, kind = benchmark_blocks(benchmark, block_bytes), benchmark.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item_id", kind), *(T.StructField(x, T.LongType()) for x in MATCH)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, steps in _rounds(blocks, batches, 1):
            for shard, texts, bench in steps:
                sizes, _, ends, _, _, best, place, *_ = search(texts, bench)
                if not len(best):
                    continue
                owner = np.searchsorted(bench.ends, np.arange(len(best)), side="right")
                begin = np.r_[0, bench.ends][owner]
                found = np.flatnonzero(best >= np.minimum(min_words, bench.ends[owner] - begin))
                doc = np.searchsorted(ends, place[found], side="right")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bench.names[k] for k in owner[found].tolist()], type=to_arrow_type(kind)),
                        longs(found - begin[found]),
                        longs(best[found]),
                        group[shard][0].column(0).take(pa.array(doc)),
                        longs(place[found] - (ends - 1 - sizes)[doc]),
                    ],
                    names=["item_id", *MATCH],
                )

    found = map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)
    best = F.min(F.struct((-F.col("length")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id", "place"))
    found = found.groupBy("item_id", "start").agg(best.alias("best"))
    return found.select("item_id", "start", (-F.col("best.less")).alias("length"), "best.doc_id", "best.place")
