"""Near-duplicates by SimHash, found by pigeonring filtering.

A fingerprint of 64 bits is cut into five segments in a ring. Fingerprints at 4 or fewer
differing bits have, by the pigeonring principle, a segment from which every chain of consecutive
segments stays within its share of the budget: the first segment equal, the first two at 1 bit or
less, three at 2, four at 3. A candidate must share the first two segments of such a chain up to
one bit in the second: distinct fingerprints are dealt by those 26 or so bits, once as they are
and once for each bit changed, and the longer chains are checked before the full comparison.

Cells that very many fingerprints crowd are not compared pair by pair. There every fingerprint
is dealt again by all values within two bits of it (one bit if it came changed) in the segments
that are left. Fingerprints at 4 or fewer bits share such a value, and those that share one are
at 4 or fewer bits, so each value links its holders, of which it has some 1,300 at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldsignal.llm.common import LOWER, UPPER, free_name, map_arrow, same_key, utf8
from fieldsignal.llm.components import components
from fieldsignal.session import materialize

WORDS, SEED, DISTANCE = 4, 42, 4
#: Width of the five segments of a fingerprint, from its low bits.
SEGMENTS = (13, 13, 13, 13, 12)
#: Unchanged fingerprints that make a cell crowded; others hold at most 14 times as many rows.
CROWDED = 1_024
#: Rows of crowded cells that are dealt again at a time.
SLICE = 100
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """The SimHash of the shingles of a text; no words give 0."""
    found = text.translate(_LOWER).split()
    if not found:
        return 0
    if len(found) <= words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(found), seed)]
    else:
        joined, digest = b" ".join(found), xxhash.xxh64_intdigest
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ends = (np.cumsum(sizes + 1) - 1).tolist()
        starts = [0, *(x + 1 for x in ends)]
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :])]
    array = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(array), 1 << 16):
        bits = np.unpackbits(array[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(array), bitorder="little").tobytes(), "little")


def _marked(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """doc_id, a hash of the text, and fp (a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(x, words, seed) for x in utf8(batch.column(2))], dtype=np.uint64)
            kept = [batch.column(0), batch.column(1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(made.view(np.int64))], names=["doc_id", "hash", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("hash"), "text")
    return map_arrow(rows, run, "doc_id long, hash long, fp long")


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id and fp (a signed long) of every row; a null text is empty."""
    return _marked(docs, words, seed).select("doc_id", "fp")


def _segment(fp, at: int):
    return F.shiftrightunsigned(fp, sum(SEGMENTS[:at])).bitwiseAND((1 << SEGMENTS[at]) - 1)


def _dealt(nodes: DataFrame) -> DataFrame:
    """Each fingerprint by ring position and its first two segments: as it is, and with a bit of the second changed."""
    cells = []
    for at in range(len(SEGMENTS)):
        after = (at + 1) % len(SEGMENTS)
        first = F.shiftleft(_segment(F.col("fp"), at), 16)
        second = _segment(F.col("fp"), after)
        for mask in (0, *(1 << bit for bit in range(SEGMENTS[after]))):
            cell = F.lit(at << 32) + first + second.bitwiseXOR(mask)
            cells.append(F.struct(cell.alias("cell"), F.lit(mask != 0).alias("probe")))
    return nodes.select("fp", F.explode(F.array(*cells)).alias("x")).select("x.cell", "x.probe", "fp")


def _chains(difference: np.ndarray, at: np.ndarray, limit: int) -> np.ndarray:
    """Whether every chain from the segment ``at`` stays within its share of the budget."""
    m = len(SEGMENTS)
    parts, low = [], 0
    for width in SEGMENTS:
        parts.append(np.bitwise_count(difference >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64))
        low += width
    table = np.stack(parts)
    good, total = np.ones(len(difference), dtype=bool), np.zeros(len(difference), dtype=np.int64)
    for k in range(m):
        total += table[(at + k) % m, np.arange(len(difference))]
        good &= total * m <= (k + 1) * limit
    return good


def _linked(cells: np.ndarray, probes: np.ndarray, fps: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the cells of sorted rows: every fingerprint to the least one of its component in the cell."""
    starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    ends = np.r_[starts[1:], len(cells)]
    held = np.add.reduceat(~probes, starts)
    busy = (held > 0) & (ends - starts > 1)
    out_a, out_b = [], []
    starts, ends, held = starts[busy], ends[busy], held[busy]
    # Rows of a cell stand with the plain ones first: each is compared with all after it, in slices.
    step = 1 << 20
    at, plain = np.repeat(ends, held), _ranges(starts, held)
    reach = at - plain - 1
    bounds = np.r_[0, np.cumsum(reach)]
    lo = 0
    while lo < len(plain):
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + step, side="right")) - 1)
        a = np.repeat(plain[lo:hi], reach[lo:hi])
        b = _ranges(plain[lo:hi] + 1, reach[lo:hi])
        difference = fps[a] ^ fps[b]
        near = np.flatnonzero((difference != 0) & _chains(difference, (cells[a] >> 32).astype(np.int64), limit))
        near = near[np.bitwise_count(difference[near]) <= limit]
        out_a.append(fps[a[near]])
        out_b.append(fps[b[near]])
        lo = hi
    if not out_a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return _forest(np.concatenate(out_a), np.concatenate(out_b))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... of each size, one after another."""
    total = int(sizes.sum())
    return np.arange(total) + np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes) if total else np.zeros(0, np.int64)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components, one for each fingerprint at most."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        root = root[root]
        if (root == before).all():
            break
    while (root != root[root]).any():
        root = root[root]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _crowded_cells(nodes: DataFrame, crowded: int) -> DataFrame:
    """The cells of more than ``crowded`` unchanged fingerprints, and all cells one bit beside them."""
    plain = _dealt(nodes).where("not probe").groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > crowded)
    around = F.array(*(F.col("cell").bitwiseXOR(mask) for mask in (0, *(1 << bit for bit in range(max(SEGMENTS))))))
    return materialize(plain.select(F.explode(around).alias("cell")).distinct())


def _balls(at: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The bits outside the first two segments of a chain from ``at``; their changes of up to two bits, and of up to one."""
    own, low = {at, (at + 1) % len(SEGMENTS)}, 0
    bits = []
    for k, width in enumerate(SEGMENTS):
        bits += [1 << b for b in range(low, low + width) if k not in own]
        low += width
    wide = [0, *bits, *(a | b for a, b in combinations(bits, 2))]
    return sum(bits), np.array(wide, dtype=np.uint64), np.array([0, *bits], dtype=np.uint64)


def _linked_around(rows: DataFrame) -> DataFrame:
    """Links of the rows of crowded cells, by the values within two bits (of changed ones: one) that they share."""
    balls = [_balls(at) for at in range(len(SEGMENTS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                cells = part.column(0).to_numpy()
                probes = part.column(1).to_numpy(zero_copy_only=False)
                fps = part.column(2).to_numpy().view(np.uint64)
                for at, probe in set(zip((cells >> 32).tolist(), probes.tolist())):
                    mine = np.flatnonzero((cells >> 32 == at) & (probes == probe))
                    rest, wide, narrow = balls[at]
                    masks = narrow if probe else wide
                    value = ((fps[mine] & np.uint64(rest))[:, None] ^ masks).ravel()
                    arrays = (np.repeat(cells[mine], len(masks)), value.view(np.int64), np.repeat(fps[mine], len(masks)).view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["cell", "value", "fp"])

    shared = map_arrow(rows.select("cell", "probe", "fp"), run, "cell long, value long, fp long")
    held = shared.groupBy("cell", "value").agg(F.collect_set("fp").alias("x")).where(F.size("x") > 1)
    return held.select(F.explode("x").alias("a"), F.array_min("x").alias("b")).where("a <> b")


def links(nodes: DataFrame, limit: int = DISTANCE, crowded: int = CROWDED) -> DataFrame:
    """a, b: links whose components are those of all pairs of distinct fingerprints at ``limit`` or fewer bits."""
    if limit != DISTANCE:
        raise ValueError("the segments are cut for a distance of 4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(rows: pa.Table):
            cells = rows.column("cell").to_numpy()
            probes = rows.column("probe").to_numpy(zero_copy_only=False)
            a, b = _linked(cells, probes, rows.column("fp").to_numpy().view(np.uint64), limit)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(x.num_rows for x in held) < 200_000:
                continue
            rows = pa.Table.from_batches(held)
            cells = rows.column("cell").to_numpy()
            cut = int(np.searchsorted(cells, cells[-1]))  # the last cell may go on
            if cut:
                yield from solve(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            yield from solve(pa.Table.from_batches(held))

    hot = _crowded_cells(nodes, crowded)
    dealt = _dealt(nodes).join(hot, "cell", "left_anti")
    found = map_arrow(dealt.repartition("cell").sortWithinPartitions("cell", "probe"), run, "a long, b long")
    if not hot.isEmpty():
        found = found.union(_linked_around(_dealt(nodes).join(hot, "cell", "left_semi")))
    return found.distinct()


def _rooted(docs: DataFrame, words: int, seed: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """The marked rows, written; and of every fingerprint: fp, first (its least doc_id), best (its row to keep), root."""
    marked = materialize(_marked(docs, words, seed))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "hash")).alias("best")
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), best))
    roots = materialize(components(links(nodes.select("fp"), limit)))
    named = same_key(nodes, roots.select(F.col("node").alias("fp"), "root"), ["fp"], "left")
    return marked, named.select("fp", "first", "best", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, words: int = WORDS, seed: int = SEED, limit: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    Rows whose fingerprints are linked by chains of ``limit`` or fewer bits share the smallest
    doc_id of their component. Null and empty texts have fingerprint 0 and are linked like any
    other. A null doc_id is linked but never names a component, unless no other id is in it.
    Repeated rows stay. Only distinct fingerprints are compared: at most one row of each enters a
    cell, so copies cost nothing, and cells that many near-copies crowd are dealt again.
    """
    marked, named = _rooted(docs, words, seed, limit)
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.join(named.join(least, "root").select("fp", "component_id"), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, words: int = WORDS, seed: int = SEED, limit: int = DISTANCE) -> DataFrame:
    """One row of docs, all columns, of each component: that of the smallest doc_id (null last).

    Rows of one id are ordered by fingerprint, then by a 64-bit hash of the text, which also finds
    the row again: fingerprints are made once and texts are shuffled once. Rows that repeat an id
    and a text are copies of one another, and one stays.
    """
    _, named = _rooted(docs, words, seed, limit)
    kept = named.groupBy("root").agg(F.min("best").alias("best")).select("best.doc_id", "best.hash")
    names = [free_name(docs, x) for x in ("id", "none", "hash")]
    row = free_name(docs, "row")

    def key(doc_id: Column, text_hash: Column) -> dict[str, Column]:
        doc_id = doc_id.cast("long")
        return dict(zip(names, (F.coalesce(doc_id, F.lit(0)), doc_id.isNull(), text_hash)))

    wanted = kept.select(*(x.alias(name) for name, x in key(F.col("doc_id"), F.col("hash")).items()))
    found = docs.withColumns(key(F.col("doc_id"), F.xxhash64("text"))).join(wanted, names, "left_semi")
    first = Window.partitionBy(*names).orderBy(names[2])
    return found.withColumn(row, F.row_number().over(first)).where(F.col(row) == 1).select(*docs.columns)
