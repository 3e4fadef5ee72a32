"""Removal of repeated byte strings across all texts, by suffix sorting one bucket at a time.

Every start of a ``LENGTH``-byte string belongs to the bucket of the least gram hash inside that
string, so equal strings meet in one bucket wherever they stand. Neighbouring starts of a text
with the same bucket make a run. Runs of equal bytes are told from their first occurrence by
their hashes alone; only runs that share a bucket with different runs are sorted byte by byte.
Their suffixes are sorted bucket by bucket in blocks of bounded size; ties longer than a period
are resolved by the ranks of a difference-cover sample of the block.

Copies are pre-aggregated in each task before the shuffle, so a bucket holds at most one run of
the same bytes from each chunk of texts. A bucket with very many different runs (a common line in
ever other surroundings) is dealt on by the hashes of its single strings.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldsignal.llm.common import free_name, longs, map_arrow, utf8
from fieldsignal.llm.suffixes import PAD, repeats, sort_suffixes
from fieldsignal.session import materialize

LENGTH, GRAM = 100, 40
#: Bytes of texts that a task takes up at once, and of a block of buckets that is sorted at once.
CHUNK_BYTES, BLOCK_BYTES = 3 << 20, 3 << 20
#: Different runs of a bucket beyond which its strings are dealt singly.
HOT_RUNS = 2_000
#: Starts of a run at most: periodic text has one bucket throughout.
RUN_STARTS = 256
#: Stands for a null id: before all others.
NO_ID = -(1 << 63)

_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)
FIRST, PERIODIC, COPY = 0, 1, 2  # kinds of runs
REMOVE, SORT, HOT = 0, 1, 2  # kinds of marks


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place."""
    n = max(0, len(text) - GRAM + 1)
    view = np.ndarray((max(0, len(text) - 7),), "<u8", text, strides=(1,))
    h = view[:n] * _MIX[0]
    for j in range(8, GRAM, 8):
        h += view[j : j + n]
        h *= _MIX[0]
    h ^= h >> np.uint64(32)
    h *= _MIX[1]
    h ^= h >> np.uint64(29)
    return h


def _sliding(values: np.ndarray, width: int, best, rest) -> np.ndarray:
    """The best of each ``width`` neighbouring values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, rest, dtype=np.uint64)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = best.accumulate(rows, axis=1).ravel()
    behind = best.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[:n], ahead[width - 1 : width - 1 + n])


def runs_of(text: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """The runs of a chunk of texts that lie end to end: bucket, content, start, starts, periodic."""
    width = LENGTH - GRAM + 1
    none = np.zeros(0, dtype=np.int64)
    if len(text) < LENGTH:
        return {"key": none, "content": none, "start": none, "size": none, "periodic": none.astype(bool)}
    h = gram_hashes(text)
    least = _sliding(h, width, np.minimum, _MOST)
    sizes = np.diff(np.r_[0, ends])
    end = np.repeat(ends, sizes)[: len(least)]
    change = (least[1:] != least[:-1]) | (end[1:] != end[:-1])
    start = np.r_[0, np.flatnonzero(change) + 1]
    stop = np.minimum(np.r_[start[1:], len(least)], end[start] - LENGTH + 1)
    start, stop = start[stop > start], stop[stop > start]
    # long runs are cut
    pieces = -(-(stop - start) // RUN_STARTS)
    which = np.repeat(np.arange(len(start)), pieces)
    number = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start, stop = start[which] + number * RUN_STARTS, np.minimum(stop[which], start[which] + (number + 1) * RUN_STARTS)
    size = stop - start
    content = h[start] * _MIX[0] + size.astype(np.uint64)
    last = stop - 1 + LENGTH - GRAM
    for j in range(1, -(-(RUN_STARTS + LENGTH) // GRAM)):
        content = (content ^ (content >> np.uint64(31))) * _MIX[1] + h[np.minimum(start + j * GRAM, last)]
    # A run can repeat one of its own strings only if its least hash stands twice in it: all places
    # that are least of some string are looked through, eight neighbours far; more are taken as such.
    held = np.r_[np.full(width - 1, least[0]), least, np.full(width - 1, least[-1])]
    held[: width - 1], held[len(least) + width - 1 :] = 0, 0
    top = _sliding(held, width, np.maximum, np.uint64(0))[: len(h)]
    places = np.flatnonzero(h == top)
    twice = np.zeros(len(places), dtype=np.int64)
    for t in range(1, 8):
        near = places[t:] - places[:-t] <= RUN_STARTS + LENGTH
        twice[t:] |= near & (h[places[t:]] == h[places[:-t]])
    total = np.r_[0, np.cumsum(twice)]
    lo, hi = np.searchsorted(places, start), np.searchsorted(places, last, side="right")
    periodic = (hi - lo > 8) | (total[hi] - total[lo] > 0)
    return {
        "key": least[start].view(np.int64),
        "content": content.view(np.int64),
        "start": start,
        "size": size,
        "periodic": periodic,
    }


def _join_up(doc: np.ndarray, pos: np.ndarray, size: np.ndarray):
    """Runs of starts that follow one another in a text, as one."""
    if not len(doc):
        return doc, pos, size
    sort = np.lexsort((pos, doc))
    doc, pos, size = doc[sort], pos[sort], size[sort]
    fresh = np.r_[True, (doc[1:] != doc[:-1]) | (pos[1:] > pos[:-1] + size[:-1])]
    head = np.flatnonzero(fresh)
    stop = np.maximum.reduceat(pos + size, head)
    return doc[head], pos[head], stop - pos[head]


RUNS = "route long, content long, doc long, pos long, size long, kind int"


def _find_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for docs, texts in _chunks(batches):
        sizes = np.array([len(x) for x in texts], dtype=np.int64)
        ends = np.cumsum(sizes)
        text = np.frombuffer(b"".join(texts), np.uint8)
        run = runs_of(text, ends)
        owner = np.searchsorted(ends, run["start"], side="right")
        tags = np.array([zlib.crc32(x) & 0x7FFFFFFF for x in texts], dtype=np.int64)
        doc = docs[owner]
        pos = (tags[owner] << 32) + run["start"] - (ends - sizes)[owner]
        sort = np.lexsort((pos, doc, run["content"], run["key"]))
        key, content = run["key"][sort], run["content"][sort]
        doc, pos, size = doc[sort], pos[sort], run["size"][sort]
        fresh = np.r_[True, (key[1:] != key[:-1]) | (content[1:] != content[:-1])][: len(key)]
        head = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0)) if len(key) else sort
        again = (doc == doc[head]) & (pos == pos[head]) & ~fresh  # the same row once more
        copy = ~fresh & ~again
        kind = np.where(run["periodic"][sort], PERIODIC, FIRST)[fresh]
        c_doc, c_pos, c_size = _join_up(doc[copy], pos[copy], size[copy])
        route = np.r_[key[fresh], (c_doc * 1_000_003) ^ (c_pos * 7_919)]
        columns = [
            route,
            np.r_[content[fresh], np.zeros(len(c_doc), dtype=np.int64)],
            np.r_[doc[fresh], c_doc],
            np.r_[pos[fresh], c_pos],
            np.r_[size[fresh], c_size],
        ]
        kinds = np.r_[kind, np.full(len(c_doc), COPY)].astype(np.int32)
        for at in range(0, len(route), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays(
                [*(longs(c[part]) for c in columns), pa.array(kinds[part])],
                names=["route", "content", "doc", "pos", "size", "kind"],
            )


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


MARKS = "bucket long, doc long, pos long, size long, mark int"


def _marks(bucket, doc, pos, size, mark) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [longs(bucket), longs(doc), longs(pos), longs(size), pa.array(np.asarray(mark, dtype=np.int32))],
        names=["bucket", "doc", "pos", "size", "mark"],
    )


def _compare_runs(batches: Iterator[pa.RecordBatch], hot_runs: int) -> Iterator[pa.RecordBatch]:
    """Runs sorted by bucket and content, in a stream: copies are removed, different runs of a bucket go on.

    Nothing of a bucket is held but its last content and its first run, which goes on when a second comes.
    """
    key = content = doc = pos = None
    number, waiting = 0, None
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        at = {n: batch.column(n).to_numpy() for n in ("route", "content", "doc", "pos", "size")}
        copy = kind == COPY
        if copy.any():
            n = int(copy.sum())
            yield _marks(at["route"][copy], at["doc"][copy], at["pos"][copy], at["size"][copy], np.full(n, REMOVE))
        at = {n: x[~copy] for n, x in at.items()}
        kind = kind[~copy]
        if not len(kind):
            continue
        keys, contents = at["route"], at["content"]
        new_key = np.r_[keys[0] != key, keys[1:] != keys[:-1]] if key is not None else np.r_[True, keys[1:] != keys[:-1]]
        new = new_key | np.r_[contents[0] != content, contents[1:] != contents[:-1]]
        index = np.arange(len(keys))
        head = np.maximum.accumulate(np.where(new, index, -1))
        first_doc = np.where(head < 0, doc if doc is not None else 0, at["doc"][head])
        first_pos = np.where(head < 0, pos if pos is not None else 0, at["pos"][head])
        again = (at["doc"] == first_doc) & (at["pos"] == first_pos)
        removed = ~new & ~again
        # The number of each content in its bucket, from 0.
        seen = np.cumsum(new)
        start = np.maximum.accumulate(np.where(new_key, index, -1))
        order = np.where(start < 0, number + seen, seen - seen[start])
        found = np.flatnonzero(new)
        go = np.zeros(len(keys), dtype=bool)
        go[found] = (order[found] > 0) | (kind[found] == PERIODIC)
        if len(found):
            followed = np.r_[~new_key[found[1:]], False]
            go[found] |= followed
            if waiting is not None and not new_key[found[0]]:
                yield _marks(*([x] for x in waiting), [SORT])
            last = found[-1]
            if order[last] == 0 and not go[last]:
                waiting = keys[last], at["doc"][last], at["pos"][last], at["size"][last]
            else:
                waiting = None
        hot = new & (order == hot_runs)
        out = np.flatnonzero(removed | go | hot)
        if len(out):
            mark = np.where(removed[out], REMOVE, SORT)
            yield _marks(keys[out], at["doc"][out], at["pos"][out], at["size"][out], mark)
        if hot.any():
            h = np.flatnonzero(hot)
            yield _marks(keys[h], at["doc"][h], at["pos"][h], at["size"][h], np.full(len(h), HOT))
        key, content, number = keys[-1], contents[-1], int(order[-1])
        doc, pos = int(first_doc[-1]), int(first_pos[-1])


SEGMENTS = "bucket long, doc long, pos long, size long, bytes binary"


def _segments(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows)
    types = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types)], names=["bucket", "doc", "pos", "size", "bytes"]
    )


def _cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs that go on; strings of hot buckets singly, equal ones of a task once.

    A row without bytes marks strings for removal.
    """
    unpack = zstandard.ZstdDecompressor()
    rows, size = [], 0
    single: dict[bytes, tuple[int, int]] = {}
    for batch in batches:
        for doc, tag, packed, runs in zip(*(batch.column(n).to_pylist() for n in ("doc", "tag", "packed", "runs"))):
            text = unpack.decompress(packed)
            for run in runs:
                pos, bucket, n = run["pos"], run["bucket"], run["size"]
                at = pos & 0xFFFFFFFF
                if not run["hot"]:
                    rows.append((bucket, doc, pos, n, text[at : at + n - 1 + LENGTH]))
                    size += n + LENGTH
                    continue
                for k in range(n):
                    string, here = text[at + k : at + k + LENGTH], (doc, pos + k)
                    known = single.setdefault(string, here)
                    if known != here:
                        lost = max(known, here)
                        single[string] = min(known, here)
                        rows.append((hash(lost) & _HALF, *lost, 1, None))
            if len(single) > 100_000:
                yield from _single(single)
                single = {}
            if len(rows) >= 20_000 or size > 8 << 20:
                yield _segments(rows)
                rows, size = [], 0
    if rows:
        yield _segments(rows)
    yield from _single(single)


_HALF = (1 << 62) - 1


def _single(strings: dict[bytes, tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    rows = [
        (int.from_bytes(hashlib.blake2b(x, digest_size=7).digest(), "little"), doc, pos, 1, x)
        for x, (doc, pos) in strings.items()
    ]
    for at in range(0, len(rows), 20_000):
        yield _segments(rows[at : at + 20_000])


def sort_block(segments: list[bytes], doc: np.ndarray, pos: np.ndarray, size: np.ndarray):
    """doc, pos, size of the strings of a block of whole buckets that stand earlier in the block."""
    sizes = np.array([len(x) for x in segments], dtype=np.int64)
    text = np.frombuffer(b"".join(segments) + bytes(PAD), np.uint8)
    row = np.repeat(np.arange(len(size)), size)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    places = (np.cumsum(sizes) - sizes)[row] + offset
    order, first = sort_suffixes(text, places)
    same = repeats(text, places, order, first, LENGTH)
    group = np.cumsum(~same)
    d, p = doc[row[order]], (pos[row] + offset)[order]
    keep = same | np.r_[same[1:], False][: len(same)]  # alone in its group: nothing to do
    group, d, p = group[keep], d[keep], p[keep]
    sort = np.lexsort((p, d, group))
    group, d, p = group[sort], d[sort], p[sort]
    fresh = np.r_[True, group[1:] != group[:-1]][: len(group)]
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(group)), 0)) if len(group) else sort
    later = ~((d == d[head]) & (p == p[head]))
    return _join_up(d[later], p[later], np.ones(int(later.sum()), dtype=np.int64))


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole buckets, each sorted by itself."""
    held, size = [], 0

    def solve(rows: pa.Table) -> pa.RecordBatch:
        at = [rows.column(n).to_numpy() for n in ("doc", "pos", "size")]
        found = sort_block(rows.column("bytes").to_pylist(), *at)
        return pa.RecordBatch.from_arrays([longs(x) for x in found], names=["doc", "pos", "size"])

    for batch in batches:
        marks = batch.column("bytes").is_null()
        if marks.true_count:
            yield batch.filter(marks).select(["doc", "pos", "size"])
            batch = batch.filter(pa.compute.invert(marks))
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size > BLOCK_BYTES:
            rows = pa.Table.from_batches(held)
            buckets = rows.column("bucket").to_numpy()
            cut = int(np.searchsorted(buckets, buckets[-1]))  # the last bucket may go on
            if cut:
                yield solve(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
                size = sum(x.nbytes for x in held)
    if held:
        yield solve(pa.Table.from_batches(held))


PACKED = "doc long, tag long, packed binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = utf8(batch.column(1))
        docs = [NO_ID if x is None else x for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                longs(docs),
                longs([zlib.crc32(x) & 0x7FFFFFFF for x in texts]),
                pa.array([pack.compress(x) for x in texts], type=pa.binary()),
            ],
            names=["doc", "tag", "packed"],
        )


def repeated_starts(docs: DataFrame, hot_runs: int = HOT_RUNS) -> DataFrame:
    """doc, tag, starts: where repeated strings start in each text that has any.

    A text is named by its id (NO_ID for null) and a checksum; ``starts`` holds runs of starts,
    each as start * 2^31 + number.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    runs = map_arrow(texts, _find_runs, RUNS)
    met = runs.repartition("route").sortWithinPartitions("route", "content", "doc", "pos")
    marks = materialize(map_arrow(met, lambda batches: _compare_runs(batches, hot_runs), MARKS))
    hot = marks.where(F.col("mark") == HOT).select("bucket", F.lit(True).alias("hot")).distinct()
    runs = marks.where(F.col("mark") == SORT).join(hot, "bucket", "left")
    run = F.struct("pos", "bucket", "size", F.coalesce("hot", F.lit(False)).alias("hot"))
    runs = runs.groupBy("doc", F.shiftright("pos", 32).alias("tag")).agg(F.collect_list(run).alias("runs"))
    packed = map_arrow(texts, _pack, PACKED).join(runs, ["doc", "tag"])
    segments = map_arrow(packed, _cut_segments, SEGMENTS)
    sorted_ = map_arrow(
        segments.repartition("bucket").sortWithinPartitions("bucket"), _sort_buckets, "doc long, pos long, size long"
    )
    removed = marks.where(F.col("mark") == REMOVE).select("doc", "pos", "size").union(sorted_)
    start = F.col("pos").bitwiseAND(0xFFFFFFFF) * F.lit(1 << 31) + F.col("size")
    return removed.groupBy("doc", F.shiftright("pos", 32).alias("tag")).agg(F.collect_list(start).alias("starts"))


def spans(starts: list[int] | None) -> list[tuple[int, int]]:
    """The maximal removed runs of bytes, from runs of starts."""
    out: list[tuple[int, int]] = []
    for x in sorted(starts or ()):
        at, n = x >> 31, x & 0x7FFFFFFF
        stop = at + n - 1 + LENGTH
        if out and at <= out[-1][1]:
            if stop > out[-1][1]:
                out[-1] = out[-1][0], stop
        else:
            out.append((at, stop))
    return out


def kept_bytes(text: bytes, removed: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in removed for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for doc, packed, starts in zip(*(batch.column(n).to_pylist() for n in ("doc", "packed", "starts"))):
            text, removed = unpack.decompress(packed), spans(starts)
            kept = kept_bytes(text, removed)
            doc = None if doc == NO_ID else doc
            rows.append((doc, len(text), len(text) - len(kept), len(removed), hashlib.sha256(kept).hexdigest()))
        types = [pa.int64()] * 4 + [pa.string()]
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, type=t) for c, t in zip(columns, types)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def dedup_digest(docs: DataFrame, hot_runs: int = HOT_RUNS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Every byte that a 100-byte string covers which also starts earlier (smaller doc_id, or
    earlier in the same text) is removed. A null text is empty. A null id stands before all
    others. Repeated rows (same id and text) are one text: they do not repeat each other and
    share their result; texts of one id that differ are ordered by a checksum.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    found = map_arrow(texts, _pack, PACKED).join(repeated_starts(docs, hot_runs), ["doc", "tag"], "left")
    return map_arrow(found.select("doc", "packed", "starts"), _digest, DIGEST)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """docs with the repeated bytes taken out of ``text``, all columns and rows; n_chars follows if it is there.

    Bytes of a character that is removed in part go with it. Null texts stay null.
    """
    fields = docs.schema
    doc, tag, bytes_, null, found = (free_name(docs, n) for n in ("doc", "tag", "packed", "null", "starts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = []
            for packed, starts, empty in zip(*(batch.column(n).to_pylist() for n in (bytes_, found, null))):
                kept = kept_bytes(unpack.decompress(packed), spans(starts))
                texts.append(None if empty else kept.decode("utf-8", "ignore"))
            columns = []
            for name in fields.fieldNames():
                column = batch.column(name) if name != "text" else pa.array(texts, type=pa.string())
                if name == "n_chars":
                    column = pa.array([None if x is None else len(x) for x in texts], type=column.type)
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, names=fields.fieldNames())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = utf8(batch.column("text"))
            extra = [
                longs([NO_ID if x is None else x for x in batch.column("doc_id").to_pylist()]),
                longs([zlib.crc32(x) & 0x7FFFFFFF for x in texts]),
                pa.array([packer.compress(x) for x in texts], type=pa.binary()),
                batch.column("text").is_null(),
            ]
            others = [n for n in fields.fieldNames() if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in others), *extra], names=[*others, doc, tag, bytes_, null]
            )

    others = T.StructType([f for f in fields if f.name != "text"])
    packed_fields = T.StructType([*others.fields, *T._parse_datatype_string(
        f"`{doc}` long, `{tag}` long, `{bytes_}` binary, `{null}` boolean"
    ).fields])
    packed = map_arrow(docs, pack, packed_fields)
    starts = repeated_starts(docs).select(
        F.col("doc").alias(doc), F.col("tag").alias(tag), F.col("starts").alias(found)
    )
    return map_arrow(packed.join(starts, [doc, tag], "left"), run, fields)
