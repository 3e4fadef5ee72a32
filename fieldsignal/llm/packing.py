"""Packing of token sequences by a configuration linear program.

The lengths of all pieces make a histogram of at most ``capacity`` entries. A pattern says how
many pieces of which length share a sequence. The covering program over patterns is solved by
multiplicative weights: dynamic programming over the capacity prices patterns, and the weights of
lengths that the chosen patterns cover fall. Its solution is rounded to whole sequences as far as
pieces are left, and what remains is solved again. The plan depends on the histogram alone and
has a bounded size; pieces then find their places in it by their rank among those of their length.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldsignal.llm.common import longs, map_arrow
from fieldsignal.llm.tokens import load
from fieldsignal.session import materialize

CAPACITY, END_ID = 4096, 1
#: Rounds of the multiplicative weights, patterns priced in a round, and the step.
ROUNDS, PATTERNS, STEP = 16, 150, 0.25
#: Buckets of the two-level rank of pieces within their length.
BUCKETS = 256
#: How full a pattern must be to be taken, the share of what is left that a solution must pack for
#: another to follow, and the sequences' worth of pieces that are filled longest first in any case.
FULLNESS, PROGRESS, TAIL = 0.999, 0.02, 8
#: Distinct lengths of a rest that is packed by the exact program at most, and its simplex steps.
EXACT_LENGTHS, STEPS = 256, 600
#: Bytes of the texts whose words are looked up together (a longer text is alone), and what a row counts beside its text.
GROUP_BYTES, ROW_BYTES = 8 << 20, 100
#: Words that a worker remembers.
MEMO_WORDS = 600_000
#: New word parts that are encoded as one text.
JOINED = 2_000

# The pre-tokens inside a word without white space, the ASCII characters that make one
# pre-token behind letters, the characters other than those for which lower-casing and white space
# are the same in the tokenizer and here, and the one that lower-casing makes two.
WORD_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
CLOSERS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
NOT_PLAIN = r"[^\x{09}-\x{0d}\x{20}-\x{7f}\x{a0}-\x{2ff}]"
DOTTED_I, DOTTED_I_LOWER = "\u0130", "i\u0307"


class Memo(dict):
    """Ids, as little-endian bytes, of lower-cased words and parts of words that were met."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit, Sequence

        super().__init__()
        self.tokenizer = load(path)[0]
        # For words that are normalised and split already, many in a text with spaces between.
        self.inner = Tokenizer(self.tokenizer.model)
        self.inner.pre_tokenizer = Sequence(
            [CharDelimiterSplit(" "), ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.split = regex.compile(WORD_PARTS).findall
        ids = self.inner.get_vocab()
        self.closes = np.zeros(max(ids.values()) + 1, dtype=bool)  # the ids that end a word
        self.closes[[k for token, k in ids.items() if token.endswith(WORD_END)]] = True

    def word_ids(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Binaries with the ids of different words, and the place of each word among them.

        The closers behind letters are looked up apart, so that words that differ in them are one.
        """
        heads = pc.ascii_rtrim(words, CLOSERS)
        heads = pc.if_else(pc.utf8_is_alpha(heads), heads, words)
        closed = pc.subtract(pc.binary_length(words), pc.binary_length(heads)).to_numpy()
        more = np.flatnonzero(closed)
        tails = [w[-n:] for w, n in zip(_strings(words.take(pa.array(more))), closed[more].tolist())]
        head_ids, tail_ids = self.ids(heads), self.ids(pa.array(tails, type=pa.large_string()))
        whole = pc.binary_join_element_wise(head_ids.take(pa.array(more)), tail_ids, pa.scalar(b"", pa.large_binary()))
        places = np.arange(len(words))
        places[more] = len(words) + np.arange(len(more))
        return pa.concat_arrays([head_ids, whole]), places

    def ids(self, words: pa.Array) -> pa.Array:
        """The ids of each word; those that are not known yet are taken in."""
        met = words.dictionary_encode()
        names = _strings(met.dictionary)
        found = list(map(self.get, names))
        new = [k for k, ids in enumerate(found) if ids is None]
        self.learn([names[k] for k in new])
        for k in new:
            found[k] = self[names[k]]
        return pa.array(found, type=pa.large_binary()).take(met.indices)

    def learn(self, new: list[str]) -> None:
        """Take in words that are not known yet."""
        split = {w: self.split(w) for w in new if not w.isalpha()}
        parts = [w for w in new if w not in split]
        parts += {p for found in split.values() for p in found if p not in self}
        for lo in range(0, len(parts), JOINED):
            some = parts[lo : lo + JOINED]
            self.update(zip(some, self.encoded(some), strict=True))
        for word, found in split.items():
            if len(found) != 1:
                self[word] = b"".join([self[p] for p in found])

    def encoded(self, parts: list[str]) -> list[bytes]:
        """The ids of each part: the parts are encoded as one text, whose ids are cut at the ends of words."""
        made = self.inner.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids
        ids = np.array(made, dtype="<u4")
        ends = (4 * (np.flatnonzero(self.closes[ids]) + 1)).tolist()
        held = ids.tobytes()
        return [held[a:b] for a, b in zip([0, *ends], ends)]


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


@lru_cache(maxsize=2)
def _memo(path: str) -> Memo:
    return Memo(path)


def encode(path: str, texts: pa.Array) -> list[bytes]:
    """The ids of each text: by different words where that is the same, else by the tokenizer."""
    memo, added = _memo(path), load(path)[1]
    if len(memo) > MEMO_WORDS:
        memo.clear()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    odd = pc.match_substring_regex(texts, "|".join([NOT_PLAIN, *map(re.escape, added)]))
    plain = pc.if_else(odd, pa.scalar("", pa.large_string()), texts)
    words = pc.utf8_split_whitespace(pc.utf8_lower(pc.replace_substring(plain, DOTTED_I, DOTTED_I_LOWER)))
    met = words.flatten().dictionary_encode()
    known, places = memo.word_ids(met.dictionary)
    places = places[met.indices.to_numpy()]
    ids = known.take(pa.array(places))
    sizes = pc.binary_length(known).to_numpy()[places]
    bounds = np.concatenate([[0], np.cumsum(sizes)])[words.offsets.to_numpy()].tolist()
    held = memoryview(ids.buffers()[2] or b"")
    out = [bytes(held[a:b]) for a, b in zip(bounds, bounds[1:])]
    for k in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
        made = memo.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids
        out[k] = np.array(made, dtype="<u4").tobytes()
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in groups of bounded bytes."""
    held, size = [], 0
    for batch in batches:
        first = 0
        for k, n in enumerate(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()):
            if size and size + n > GROUP_BYTES:
                yield pa.concat_batches([*held, batch.slice(first, k - first)])
                held, size, first = [], 0, k
            size += n + ROW_BYTES
        held.append(batch.slice(first))
    if size:
        yield pa.concat_batches(held)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, capacity: int, end_id: int):
    closing = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches):
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(path, batch.column(1))):
                ids += closing
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def price(values: np.ndarray, capacity: int) -> np.ndarray:
    """best[c]: the largest value of pieces of c tokens or fewer, with values by length."""
    values = values.astype(np.float32)
    behind = np.zeros(capacity + 1, dtype=np.float32)  # best[c] at capacity - c, so that sums run forward
    sums = np.empty(capacity, dtype=np.float32)
    for c in range(1, capacity + 1):
        found = np.add(values[1 : c + 1], behind[capacity - c + 1 :], out=sums[:c]).max()
        behind[capacity - c] = max(behind[capacity - c + 1], found)
    return behind[::-1].copy()


def _pattern(values: np.ndarray, best: np.ndarray, first: int, capacity: int) -> dict[int, int]:
    """The best pattern that holds a piece of the length ``first``."""
    pattern, left = {first: 1}, capacity - first
    while left > 0:
        sums = values[1 : left + 1] + best[left - 1 :: -1][:left]
        length = int(sums.argmax()) + 1
        if sums[length - 1] < best[left] * (1 - 1e-5) or not np.isfinite(values[length]):
            if best[left - 1] < best[left]:
                break
            left -= 1
            continue
        pattern[length] = pattern.get(length, 0) + 1
        left -= length
    return pattern


def _fractional(counts: np.ndarray, capacity: int) -> list[tuple[float, dict[int, int]]]:
    """Patterns with their amounts: multiplicative weights for the covering program."""
    present = np.flatnonzero(counts)
    weights = np.full(capacity + 1, -np.inf)
    weights[present] = present / capacity
    covered, amounts, patterns = np.zeros(capacity + 1), [], []
    for _ in range(ROUNDS):
        best = price(weights, capacity)
        worth = weights[present] + best[capacity - present]
        chosen = present[np.argsort(-worth, kind="stable")[:PATTERNS]]
        for first in chosen:
            pattern = _pattern(weights, best, int(first), capacity)
            lengths = np.fromiter(pattern, dtype=np.int64)
            times = np.fromiter(pattern.values(), dtype=np.int64)
            amount = STEP * (counts[lengths] / times).min()
            amounts.append(amount)
            patterns.append(pattern)
            gain = amount * times / counts[lengths]
            covered[lengths] += gain
            weights[lengths] *= np.exp(-gain)
    scale = max(1.0, covered[present].mean())
    return [(x / scale, p) for x, p in zip(amounts, patterns)]


def _exact(counts: np.ndarray, capacity: int) -> list[tuple[float, dict[int, int]]]:
    """Patterns with their amounts: the covering program by simplex steps, columns priced as they are needed.

    Any step leaves a solution, so their bound only ends the improvement.
    """
    present = np.flatnonzero(counts)
    rows = {int(length): k for k, length in enumerate(present)}
    basis = [{int(length): capacity // int(length)} for length in present]
    inverse = np.diag([1.0 / (capacity // int(length)) for length in present])
    amounts = inverse @ counts[present]
    values = np.full(capacity + 1, -np.inf)
    for _ in range(STEPS):
        dual = inverse.sum(axis=0)
        values[present] = np.maximum(dual, 0)
        best = price(values, capacity)
        worth = values[present] + best[capacity - present]
        if worth.max() <= 1 + 1e-5:
            break
        pattern = _pattern(values, best, int(present[worth.argmax()]), capacity)
        column = np.zeros(len(present))
        for length, times in pattern.items():
            column[rows[length]] = times
        if dual @ column <= 1 + 1e-6:
            break
        step = inverse @ column
        ratio = np.where(step > 1e-9, amounts / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        moved = ratio[out]
        amounts = np.maximum(amounts - moved * step, 0)
        amounts[out] = moved
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        basis[out] = pattern
    return list(zip(amounts.tolist(), basis))


def _finish(left: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """The better of two fillings of what is left: longest first, or the rounded program and then longest first."""
    filled = _fill(left.copy(), capacity)
    if not 0 < np.count_nonzero(left) <= EXACT_LENGTHS:
        return filled
    chosen, rest = [], left.copy()
    for amount, pattern in sorted(_exact(left, capacity), key=lambda x: -x[0]):
        n = _take(pattern, math.floor(amount + 1e-6), rest)
        if n:
            chosen.append((n, pattern))
            for length, times in pattern.items():
                rest[length] -= n * times
    chosen += _fill(rest, capacity)
    return min(filled, chosen, key=lambda x: sum(n for n, _ in x))


def _take(pattern: dict[int, int], wanted: int, left: np.ndarray) -> int:
    return min(wanted, *(int(left[length]) // times for length, times in pattern.items()))


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Patterns with the number of sequences that follow each; together they hold every piece.

    counts[l] is the number of pieces of l tokens. A solution is rounded up, pattern by pattern, as
    far as pieces are left, and what is left is solved again while that packs a part of it. The
    rest, which has no full patterns, is packed by the exact program or longest first, whichever
    takes fewer sequences.
    """
    left, chosen = counts.astype(np.int64).copy(), []
    if left[capacity]:
        chosen.append((int(left[capacity]), {capacity: 1}))
        left[capacity] = 0
    lengths = np.arange(capacity + 1)
    while (left * lengths).sum() > TAIL * capacity:
        before = (left * lengths).sum()
        for amount, pattern in sorted(_fractional(left, capacity), key=lambda x: -x[0]):
            if sum(length * times for length, times in pattern.items()) < FULLNESS * capacity:
                continue
            n = _take(pattern, math.ceil(amount), left)
            if n:
                chosen.append((n, pattern))
                for length, times in pattern.items():
                    left[length] -= n * times
        if (left * lengths).sum() > (1 - PROGRESS) * before:
            break
    return chosen + _finish(left, capacity)


def _fill(left: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Patterns for the pieces that are left: the longest, then always the longest that still fits.

    Each pattern is taken until one of its lengths has run out, so there are no more than lengths.
    """
    chosen = []
    while left.any():
        room, pattern = capacity, {}
        free = left.copy()
        while room:
            fits = np.flatnonzero(free[: room + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            pattern[length] = pattern.get(length, 0) + 1
            free[length] -= 1
            room -= length
        n = min(int(left[length]) // times for length, times in pattern.items())
        for length, times in pattern.items():
            left[length] -= n * times
        chosen.append((n, pattern))
    return chosen


def slots(chosen: list[tuple[int, dict[int, int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: the first rank of each run of slots, its first sequence, its slots a sequence and their offset."""
    runs: dict[int, list] = {}
    base, ranks = 0, {}
    for n, pattern in chosen:
        offset = 0
        for length, times in pattern.items():
            rank = ranks.get(length, 0)
            runs.setdefault(length, []).append((rank, base, times, offset))
            ranks[length] = rank + n * times
            offset += length * times
        base += n
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*rows)) for length, rows in runs.items()}


PLACED = PIECES + ", sequence_id long, offset long"


def _place(places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = places.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
            for one in np.unique(length):
                at = np.flatnonzero(length == one)
                first, base, times, start = by_length[int(one)]
                k = np.searchsorted(first, rank[at], side="right") - 1
                copy, slot = np.divmod(rank[at] - first[k], times[k])
                sequence[at], offset[at] = base[k] + copy, start[k] + slot * one
            kept = [batch.column(name) for name in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, longs(sequence), longs(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every row.

    A null text is empty and has the closing id alone. Repeated rows are packed each. The
    histogram and the plan are bounded by the capacity, not by the rows; no rows give no pieces.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    pieces = materialize(map_arrow(texts, _pieces(tokenizer, capacity, end_id), PIECES))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BUCKETS)).cast("int"))
    sizes = materialize(pieces.groupBy("length", "bucket").count())
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect():  # at most `capacity` rows
        counts[row["length"]] = row["n"]
    places = docs.sparkSession.sparkContext.broadcast(slots(plan(counts, capacity)))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("number", F.row_number().over(within)).join(starts, ["length", "bucket"])
    ranked = ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("number") - 1).alias("rank")
    )
    return map_arrow(ranked, _place(places), PLACED)
