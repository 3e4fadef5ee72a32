"""Token counts of whole texts without their ids.

Every text is split into the tokenizer's pre-tokens; a task turns the texts of a chunk into one
posting row per distinct pre-token: which texts hold it, and how often. The posting rows of a
group of chunks meet by pre-token, whose pieces are counted once for all of them, and the products
are summed per text.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldsignal.llm.common import longs, map_arrow, utf8

#: Texts and bytes of a chunk at most (a longer text is a chunk of its own).
CHUNK_TEXTS, CHUNK_BYTES = 60_000, 16 << 20
#: A group holds the chunks of so many neighbouring partitions, up to so many of each: 96 at most.
GROUP_PARTITIONS, GROUP_CHUNKS = 16, 6
#: The pre-tokens of a group are dealt to so many buckets; each hands on one sum for a text at most.
BUCKETS = 32

# The pattern of byte-level pre-tokens, and the characters on whose class the
# pattern engines of all Unicode versions agree. Texts with others go to the tokenizer as they are.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN = r"[\u0000-ԯ‐-‧‰-⁞₠-₿ぁ-ゖァ-ヺ一-龥가-힣]*"


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer and the strings of its added tokens."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as file:
        added = [x["content"] for x in json.load(file)["added_tokens"]]
    return tokenizer, added


def _lengths(path: str, texts: list[str]) -> list[int]:
    return [len(x.ids) for x in load(path)[0].encode_batch_fast(texts, add_special_tokens=False)]


def group_of(number: int) -> int:
    """The group of a chunk, whose number holds its partition and its place there."""
    partition, serial = number >> 32, number & 0xFFFFFFFF
    return (partition // GROUP_PARTITIONS) << 32 | serial // GROUP_CHUNKS


def _chunk(path: str, ids: list, texts: list[bytes], number: int) -> Iterator[tuple]:
    split, plain = regex.compile(PRE_TOKEN).findall, regex.compile(PLAIN).fullmatch
    known, numbers = np.zeros(len(texts), dtype=np.int64), defaultdict(count().__next__)
    words, sizes = [], []
    for k, raw in enumerate(texts):
        text = raw.decode()
        if not plain(text) or any(x in text for x in load(path)[1]):
            known[k] = _lengths(path, [text])[0]
            sizes.append(0)
        else:
            found = [numbers[x] for x in split(text)]
            words.append(np.array(found, dtype=np.int64))
            sizes.append(len(found))
    head = np.array([[x is None, x or 0, len(t), n] for x, t, n in zip(ids, texts, known)], dtype=np.int64)
    group = group_of(number)
    yield None, group, number % BUCKETS, number, head.tobytes()
    if not numbers:
        return
    pairs, often = np.unique(
        np.concatenate(words) * len(texts) + np.repeat(np.arange(len(texts)), sizes), return_counts=True
    )
    # A count takes one byte; a larger one is written as several entries.
    entries = -(-often // 255)
    which, text_of = np.divmod(np.repeat(pairs, entries), len(texts))
    last = np.cumsum(entries) - 1
    amount = np.full(len(which), 255, dtype=np.uint8)
    amount[last] = often - 255 * (entries - 1)
    text_of = text_of.astype("<u2")
    bounds = np.searchsorted(which, np.arange(len(numbers) + 1))
    for k, piece in enumerate(numbers):
        lo, hi = bounds[k], bounds[k + 1]
        bucket = crc32(piece.encode()) % BUCKETS
        yield piece, group, bucket, number, text_of[lo:hi].tobytes() + amount[lo:hi].tobytes()


POSTINGS = "piece string, group long, bucket long, chunk long, body binary"


def _rows(rows: Iterator[tuple], types: list) -> Iterator[pa.RecordBatch]:
    """Tuples as batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if len(held) >= 20_000 or size > 16 << 20:
            yield _batch(held, types)
            held, size = [], 0
    if held:
        yield _batch(held, types)


def _batch(rows: list[tuple], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x, type=t) for x, (_, t) in zip(zip(*rows), types)], names=[n for n, _ in types]
    )


_POSTING_TYPES = [
    ("piece", pa.string()), ("group", pa.int64()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("body", pa.binary())
]
_PARTIAL_TYPES = [("chunk", pa.int64()), ("head", pa.bool_()), ("body", pa.binary())]


def _postings(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            serial = count(TaskContext.get().partitionId() << 32)
            ids, texts, size = [], [], 0
            for batch in batches:
                for x, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                    if texts and (size + len(text) > CHUNK_BYTES or len(texts) >= CHUNK_TEXTS):
                        yield from _chunk(path, ids, texts, next(serial))
                        ids, texts, size = [], [], 0
                    ids.append(x)
                    texts.append(text)
                    size += len(text)
            if texts:
                yield from _chunk(path, ids, texts, next(serial))

        yield from _rows(rows(), _POSTING_TYPES)

    return run


def _products(path: str):
    """Postings sorted by group and pre-token to sums per chunk and text.

    The sums of a group are held until its last posting: one array for each of its chunks.
    """

    def flush(sums: dict) -> Iterator[tuple]:
        for chunk, total in sums.items():
            texts = np.flatnonzero(total)
            yield chunk, False, texts.astype("<u2").tobytes() + total[texts].astype("<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            last, pieces, held, sums = None, 0, None, {}
            for batch in batches:
                names, groups, chunks, bodies = (batch.column(k).to_pylist() for k in (0, 1, 3, 4))
                keys = list(zip(groups, names))
                fresh = [key[1] for key, before in zip(keys, [last, *keys]) if key[1] is not None and key != before]
                lengths = iter(_lengths(path, fresh))
                for key, chunk, body in zip(keys, chunks, bodies):
                    group, name = key
                    same, last = key == last, key
                    if group != held:
                        yield from flush(sums)
                        held, sums = group, {}
                    if name is None:
                        yield chunk, True, body
                        continue
                    if not same:
                        pieces = next(lengths)
                    n = len(body) // 3
                    total = sums.get(chunk)
                    if total is None:
                        total = sums[chunk] = np.zeros(CHUNK_TEXTS, dtype=np.int64)
                    if n == 1:
                        total[body[0] | body[1] << 8] += pieces * body[2]
                    else:
                        texts = np.frombuffer(body, "<u2", n)
                        np.add.at(total, texts, np.frombuffer(body, np.uint8, n, 2 * n).astype(np.int64) * pieces)
            yield from flush(sums)

        yield from _rows(rows(), _PARTIAL_TYPES)

    return run


def _totals(group: pa.Table) -> pa.Table:
    """The rows of one chunk's texts; CHUNK_TEXTS bounds them."""
    head, totals = None, np.zeros(CHUNK_TEXTS, dtype=np.int64)
    for is_head, body in zip(group.column("head").to_pylist(), group.column("body").to_pylist()):
        if is_head:
            head = np.frombuffer(body, np.int64).reshape(-1, 4)
        else:
            n = len(body) // 6
            totals[np.frombuffer(body, "<u2", n)] += np.frombuffer(body, "<u4", n, 2 * n)
    return pa.table(
        {
            "doc_id": pa.array(head[:, 1].copy(), mask=head[:, 0] == 1),
            "n_bytes": longs(head[:, 2]),
            "n_tokens": longs(head[:, 3] + totals[: len(head)]),
        }
    )


def count_tokens(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row: the tokens of the tokenizer file of a byte-level BPE.

    No added tokens are counted but those whose strings stand in the text. A null text is empty
    and has 0 tokens, a null id stays null, repeated rows are counted each; other columns are not
    read. A pre-token is counted once for each group of chunks that holds it, so that a frequent one
    is dealt by groups, and what a bucket of a group hands on is bounded by its texts.
    Texts with characters outside PLAIN go to the tokenizer whole.
    """
    texts = docs.select(F.col(id_column).cast("long"), F.col(text_column))
    postings = map_arrow(texts, _postings(tokenizer), POSTINGS)
    met = postings.repartition("group", "bucket").sortWithinPartitions("group", "piece")
    partial = map_arrow(met, _products(tokenizer), "chunk long, head boolean, body binary")
    return partial.groupBy("chunk").applyInArrow(_totals, "doc_id long, n_bytes long, n_tokens long")
