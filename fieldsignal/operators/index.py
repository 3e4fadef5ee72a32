"""Row positions, halo chunks and carried values: sequence semantics without
putting a whole series into one task.

* ``with_row_index`` numbers rows by counting per calendar bucket first.
* ``over_chunks`` evaluates bounded frames on fixed-size chunks with copied edges.
* ``nearest_known`` looks any distance back and ahead through a chunk-level summary.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fieldsignal.functions.clock import MICROS_PER_SECOND, epoch_micros
from fieldsignal.spec import SeriesSpec

CHUNK = "_chunk"


def _bucket_of(order: Column, width: int) -> Column:
    """Start of the bucket a LONG falls in. Never NULL, so that the branches that count and
    number the same rows keep identical plans and share their shuffle."""
    return F.coalesce(order - F.pmod(order, F.lit(width)), F.lit(0))


def running_counts(
    counts: DataFrame, keys: Sequence[str], order: str, widths: Sequence[int]
) -> DataFrame:
    """Add ``before``: the sum of ``n`` over smaller ``order`` values of the same keys.

    ``counts`` has one row per (keys, order). ``widths`` (coarse to fine, in units of
    ``order``) split the running sum into levels, so that no window partition spans
    more than one bucket of the next coarser level.
    """
    keys = list(keys)
    preceding = (Window.unboundedPreceding, -1)
    if not widths:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(*preceding)
        return counts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))
    bucket = f"_{order}_b"
    cut = counts.withColumn(bucket, _bucket_of(F.col(order), widths[-1]))
    w = Window.partitionBy(*keys, bucket).orderBy(order).rowsBetween(*preceding)
    totals = cut.groupBy(*keys, bucket).agg(F.sum("n").alias("n"))
    offsets = running_counts(totals, keys, bucket, widths[:-1])
    return (
        cut.withColumn("_inside", F.coalesce(F.sum("n").over(w), F.lit(0)))
        .join(offsets.select(*keys, bucket, "before"), [*keys, bucket])
        .withColumn("before", F.col("before") + F.col("_inside"))
        .drop("_inside", bucket)
    )


def with_row_index(
    df: DataFrame,
    spec: SeriesSpec,
    tie_break: Sequence[str] = (),
    length: str | None = None,
) -> DataFrame:
    """Add the 0-based chronological position per series, and its length if named.

    Rows are counted per fine time bucket; the running total of those counts is the
    offset of a bucket and ``row_number`` inside it completes the position.
    """
    *widths, fine = (seconds * MICROS_PER_SECOND for seconds in spec.bucket_seconds)
    bucket = "_bucket"
    cut = df.withColumn(bucket, _bucket_of(epoch_micros(F.col(spec.time)), fine))
    counts = cut.groupBy(*spec.keys, bucket).agg(F.count(F.lit(1)).alias("n"))
    offsets = running_counts(counts, spec.keys, bucket, widths).drop("n")
    if length:
        totals = counts.groupBy(*spec.keys).agg(F.sum("n").alias(length))
        offsets = offsets.join(totals, spec.keys)
    inside = Window.partitionBy(*spec.keys, bucket).orderBy(spec.time, *tie_break)
    position = F.row_number().over(inside) - 1
    return (
        cut.withColumn("_inside", position)
        .join(offsets, [*spec.keys, bucket])
        .withColumn(spec.index, (F.col("before") + F.col("_inside")).cast("long"))
        .drop(bucket, "_inside", "before")
    )


def attach(df: DataFrame, values: DataFrame, keys: Sequence[str], spread: Column, how: str = "inner") -> DataFrame:
    """Join one row of ``values`` per key to the rows of ``df``, of which a key may hold a large share.

    The values are laid on the table of (key, ``spread``) first, one row each; the rows then join on
    both, so that a key is dealt to as many tasks as it has values of ``spread``.
    """
    bucket = "_spread"
    cut = df.withColumn(bucket, spread)
    laid = cut.select(*keys, bucket).distinct().join(values, list(keys), how)
    return cut.join(laid, [*keys, bucket]).drop(bucket)


def by_hash(*columns: str) -> Column:
    """One of 2^20 buckets, for rows that have been counted per distinct value."""
    return F.shiftright(F.xxhash64(*columns), 44)


def chunk_of(spec: SeriesSpec) -> Column:
    return F.floor(F.col(spec.index) / spec.chunk_rows)


def over_chunks(
    df: DataFrame,
    spec: SeriesSpec,
    left: int,
    right: int,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
) -> DataFrame:
    """Run row-frame windows that look at most ``left`` rows back and ``right`` ahead.

    Every chunk receives copies of its neighbours' edge rows, ``build`` adds its columns
    over the chunk window, and only the chunk's own rows are kept: the result equals
    that of a window over the whole series.
    """
    if max(left, right) > spec.chunk_rows:
        raise ValueError("chunk_rows must be at least as large as the frame")
    own = chunk_of(spec)
    place = F.col(spec.index) % spec.chunk_rows
    targets = [own]
    if left:
        targets.append(F.when(place >= spec.chunk_rows - left, own + 1))
    if right:
        targets.append(F.when((place < right) & (own > 0), own - 1))
    padded = df.withColumn(CHUNK, F.explode(F.array_compact(F.array(*targets))))
    w = Window.partitionBy(*spec.keys, CHUNK).orderBy(spec.index)
    return build(padded, w).where(F.col(CHUNK) == own).drop(CHUNK)


#: Chunks of a group, and groups of a group above it: how readings travel along long series.
CHUNK_GROUPS = (1024, 1024)


def _carried(
    edges: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str = CHUNK, widths: Sequence[int] = CHUNK_GROUPS
) -> DataFrame:
    """Per row of ``edges`` the last known reading of the rows before it (``_cp_c``) and the first one
    of the rows after it (``_cn_c``), from each row's own last (``_l_c``) and first (``_f_c``) one.

    Inside a group of ``widths[0]`` rows a window finds it; what the group lacks comes from the table
    of groups, in the same way. So a window partition holds a group, or the few groups of the last level.
    """
    keys, inside = list(keys), list(keys)
    if widths:
        group = f"{order}_g"
        edges = edges.withColumn(group, F.floor(F.col(order) / widths[0]))
        inside.append(group)
    w = Window.partitionBy(*inside)
    earlier = w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    later = w.orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    found = edges.withColumns(
        {f"_cp_{c}": F.last(f"_l_{c}", True).over(earlier) for c in columns}
        | {f"_cn_{c}": F.last(f"_f_{c}", True).over(later) for c in columns}
    )
    if not widths:
        return found.select(*keys, order, *[f"_c{side}_{c}" for c in columns for side in "pn"])
    totals = edges.groupBy(*inside).agg(
        *[F.max(f"_l_{c}").alias(f"_l_{c}") for c in columns], *[F.min(f"_f_{c}").alias(f"_f_{c}") for c in columns]
    )
    outer = _carried(totals, keys, columns, group, widths[1:])
    outer = outer.select(*inside, *[F.col(f"_c{side}_{c}").alias(f"_o{side}_{c}") for c in columns for side in "pn"])
    return found.join(outer, inside).select(
        *keys, order, *[F.coalesce(f"_c{side}_{c}", f"_o{side}_{c}").alias(f"_c{side}_{c}") for c in columns for side in "pn"]
    )


def nearest_known(df: DataFrame, spec: SeriesSpec, columns: Sequence[str]) -> DataFrame:
    """Add, per column ``c``, position and value of the nearest non-NULL reading at or
    before the row (``_pi_c``, ``_pv_c``) and at or after it (``_ni_c``, ``_nv_c``).

    The look-back is unbounded. Chunks are reduced to their first and last known
    reading, those are carried along groups of chunks and groups of groups, and the windows over
    rows stay inside one chunk. Looking ahead is a descending window with a running
    frame, since a frame that ends in UNBOUNDED FOLLOWING is re-read for every row.
    """
    keys = [*spec.keys, CHUNK]
    idx = F.col(spec.index)

    def known(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(idx.alias("i"), F.col(c).alias("v")))

    cut = df.withColumn(CHUNK, chunk_of(spec))
    edges = cut.groupBy(*keys).agg(
        *[F.max(known(c)).alias(f"_l_{c}") for c in columns], *[F.min(known(c)).alias(f"_f_{c}") for c in columns]
    )
    rows = Window.partitionBy(*keys)
    back = rows.orderBy(spec.index).rowsBetween(Window.unboundedPreceding, 0)
    ahead = rows.orderBy(F.desc(spec.index)).rowsBetween(Window.unboundedPreceding, 0)
    found = {f"_p_{c}": F.last(known(c), True).over(back) for c in columns}
    found |= {f"_n_{c}": F.last(known(c), True).over(ahead) for c in columns}
    joined = cut.withColumns(found).join(_carried(edges, spec.keys, columns), keys)
    nearest = {f"_{side}_{c}": F.coalesce(f"_{side}_{c}", f"_c{side}_{c}") for c in columns for side in "pn"}
    split = {f"_{side}{p}_{c}": F.col(f"_{side}_{c}")[p] for c in columns for side in "pn" for p in "iv"}
    return joined.withColumns(nearest).withColumns(split).drop(
        CHUNK, *nearest, *[f"_c{side}_{c}" for c in columns for side in "pn"]
    )


def drop_nearest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*[f"_{side}{p}_{c}" for c in columns for side in "pn" for p in "iv"])
