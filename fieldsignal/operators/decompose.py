"""Empirical mode decomposition of long series, and its ensemble with adaptive noise.

A signal is packed into blocks of ``block_rows`` consecutive samples, one array per row.
What a block must know about the rest of its series (the run of equal samples it starts
in, the nearest extrema outside) is carried along a summary with one row per block.
One sift is therefore exact for series of any length, while no task holds more than
single blocks. A series that fits into one block is sifted to the end inside its task.

Blocks carry ``keys`` (the series, and the trial in an ensemble), ``chunk``, ``start``
(position of the first sample), ``size`` (samples in the series) and ``values``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldsignal.functions import sifting
from fieldsignal.session import materialize, passing_tables, ship_package
from fieldsignal.spec import TARGET, SeriesSpec

RESIDUE = 0  # number of the residue among the components; modes count from 1
TRIAL = "trial"
BLOCK = ("chunk", "start", "size")
#: Samples after which a task hands on the blocks it has made.
HELD_SAMPLES = 1_000_000


# --- packing -------------------------------------------------------------------------


def to_blocks(df: DataFrame, spec: SeriesSpec, column: str) -> DataFrame:
    """Pack an indexed column without gaps into blocks."""
    sizes = df.groupBy(*spec.keys).agg((F.max(spec.index) + 1).alias("size"))
    samples = F.sort_array(F.collect_list(F.struct(spec.index, column)))
    packed = (
        df.withColumn("chunk", F.floor(F.col(spec.index) / spec.block_rows))
        .groupBy(*spec.keys, "chunk")
        .agg(samples.alias("_s"))
    )
    return packed.join(sizes, spec.keys).select(
        *spec.keys,
        "chunk",
        F.element_at("_s", 1)[spec.index].cast("long").alias("start"),
        F.col("size").cast("long"),
        F.transform("_s", lambda s: s[column]).alias("values"),
    )


def from_blocks(blocks: DataFrame, spec: SeriesSpec, keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """One row per sample again."""
    return blocks.select(
        *spec.keys, *keep, "start", F.posexplode("values").alias("_at", value)
    ).select(*spec.keys, (F.col("start") + F.col("_at")).cast("long").alias(spec.index), *keep, value)


def _flat_map_blocks(
    blocks: DataFrame, extra: Sequence[T.StructField], kernel: Callable[[dict], list[dict]], drop: Sequence[str] = ()
) -> DataFrame:
    """Apply a helper to every block; ``extra`` are the columns it adds or replaces."""
    replaced = {f.name for f in extra} | set(drop)
    kept = [f for f in blocks.schema.fields if f.name not in replaced]
    schema = T.StructType([*kept, *extra])
    names = schema.names

    def frame(rows: list[list]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=names, dtype=object)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, held = [], 0
            for values in batch.itertuples(index=False, name=None):
                row = dict(zip(batch.columns, values))
                for part in kernel(row):
                    made = row | part
                    rows.append([made[n] for n in names])
                    held += sum(np.size(v) for v in rows[-1])
                    if held > HELD_SAMPLES:
                        yield frame(rows)
                        rows, held = [], 0
            yield frame(rows)

    ship_package(blocks.sparkSession)
    return blocks.mapInPandas(run, schema)


def _map_blocks(
    blocks: DataFrame, extra: Sequence[T.StructField], kernel: Callable[[dict], dict], drop: Sequence[str] = ()
) -> DataFrame:
    return _flat_map_blocks(blocks, extra, lambda row: [kernel(row)], drop)


VALUES = T.StructField("values", T.ArrayType(T.DoubleType()))


# --- carrying the neighbourhood along the blocks -----------------------------------------


def _array(x) -> np.ndarray:
    return np.asarray(x, dtype=float)


def _present(*parts):
    """A tuple of the parts, or None if they are missing."""
    return None if any(p is None or p != p for p in parts) else parts


EDGES = [T.StructField(n, T.DoubleType()) for n in ("head", "tail")] + [
    T.StructField(n, T.LongType()) for n in ("first_at", "first_step", "last_at", "last_step")
]
EDGE_NAMES = [f.name for f in EDGES]


def _edges(h: np.ndarray, start: int) -> dict:
    """A block's end samples and its first and last change."""
    first, last = sifting.edge_changes(h, start)
    return dict(zip(EDGE_NAMES, (h[0], h[-1], *(first or (None, None)), *(last or (None, None)))))


def _with_edges(blocks: DataFrame) -> DataFrame:
    return _map_blocks(blocks, EDGES, lambda row: _edges(_array(row["values"]), int(row["start"])))


def _series_windows(keys: Sequence[str]):
    series = Window.partitionBy(*keys)
    along, against = series.orderBy("chunk"), series.orderBy(F.desc("chunk"))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    later = against.rowsBetween(Window.unboundedPreceding, -1)
    return along, earlier, later


def _with_runs(edged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the runs of equal samples around each block, from the per-block edges."""
    along, earlier, later = _series_windows(keys)
    seam = F.when(F.col("left_value") != F.col("head"), F.sign(F.col("head") - F.col("left_value")).cast("long"))
    changes = (
        edged.select(*keys, "chunk", "start", "size", *EDGE_NAMES)
        .withColumn("left_value", F.lag("tail").over(along))
        .withColumn("right_value", F.lead("head").over(along))
        .withColumn("_seam", seam)
        .withColumn("_first", F.when(F.col("_seam").isNotNull(), F.struct(F.col("start").alias("at"), F.col("_seam").alias("step")))
                    .when(F.col("first_at").isNotNull(), F.struct(F.col("first_at").alias("at"), F.col("first_step").alias("step"))))
        .withColumn("_last", F.when(F.col("last_at").isNotNull(), F.struct(F.col("last_at").alias("at"), F.col("last_step").alias("step")))
                    .when(F.col("_seam").isNotNull(), F.struct(F.col("start").alias("at"), F.col("_seam").alias("step"))))
    )
    runs = changes.withColumns(
        {"_before": F.last("_last", True).over(earlier), "_after": F.last("_first", True).over(later)}
    ).select(
        *keys,
        "chunk",
        "left_value",
        F.coalesce(F.col("_before.at"), F.lit(0)).alias("left_at"),
        F.coalesce(F.col("_before.step"), F.lit(0)).alias("left_step"),
        "right_value",
        F.coalesce(F.col("_after.at") - 1, F.col("size") - 1).alias("right_at"),
        F.coalesce(F.col("_after.step"), F.lit(0)).alias("right_step"),
    )
    return edged.drop(*EDGE_NAMES).join(runs, [*keys, "chunk"])


RUNS = ("left_value", "left_at", "left_step", "right_value", "right_at", "right_step")
POINTS = [T.StructField(n, T.ArrayType(T.LongType())) for n in ("peaks", "troughs")]
KINDS = ("peak", "trough")


def _with_extrema(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the positions of each block's own peaks and troughs.

    Edges that the previous step has left on the blocks are used as they are.
    """
    edged = blocks if set(EDGE_NAMES) <= set(blocks.columns) else _with_edges(blocks)

    def kernel(row: dict) -> dict:
        left = _present(row["left_value"], row["left_at"], row["left_step"])
        right = _present(row["right_value"], row["right_at"], row["right_step"])
        peaks, troughs = sifting.turning_points(_array(row["values"]), int(row["start"]), left, right)
        return {"peaks": peaks, "troughs": troughs}

    return _map_blocks(_with_runs(edged, keys), POINTS, kernel, drop=RUNS)


def _anchors(kind: str) -> Column:
    """Positions the envelope passes through in a block, in order: extrema and series ends."""
    inside = F.array_compact(
        F.array(
            F.when(F.col("start") == 0, F.lit(0).cast("long")),
            F.when(F.col("start") + F.size("values") == F.col("size"), F.col("size") - 1),
        )
    )
    return F.sort_array(F.array_union(F.col(f"{kind}s"), inside))


def _with_neighbours(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the nearest envelope points outside each block and the series' extrema counts."""
    _, earlier, later = _series_windows(keys)
    whole = Window.partitionBy(*keys)
    summary = blocks
    for kind in KINDS:
        summary = summary.withColumn("_a", _anchors(kind))
        for side, place in (("first", 1), ("last", -1)):
            at = F.try_element_at("_a", F.lit(place))
            point = F.struct(at.alias("at"), F.get("values", (at - F.col("start")).cast("int")).alias("value"))
            summary = summary.withColumn(f"_{side}_{kind}", F.when(at.isNotNull(), point))
    summary = summary.select(
        *keys,
        "chunk",
        *[F.col(f"_{side}_{kind}") for side in ("first", "last") for kind in KINDS],
        *[F.size(f"{kind}s").alias(f"_n_{kind}") for kind in KINDS],
    )
    around = summary
    for kind in KINDS:
        around = around.withColumns(
            {
                f"_before_{kind}": F.last(f"_last_{kind}", True).over(earlier),
                f"_after_{kind}": F.last(f"_first_{kind}", True).over(later),
                f"n_{kind}": F.sum(f"_n_{kind}").over(whole),
            }
        )
    carried = around.select(
        *keys,
        "chunk",
        *[F.col(f"_{side}_{kind}.{p}").alias(f"{side}_{kind}_{p}") for side in ("before", "after") for kind in KINDS for p in ("at", "value")],
        *[f"n_{kind}" for kind in KINDS],
    )
    return blocks.join(carried, [*keys, "chunk"])


NEIGHBOURS = tuple(
    f"{side}_{kind}_{p}" for side in ("before", "after") for kind in KINDS for p in ("at", "value")
)
COUNTS = tuple(f"n_{kind}" for kind in KINDS)


def _envelope(row: dict, kind: str) -> np.ndarray:
    points = np.asarray(row[f"{kind}s"], dtype=np.int64)
    before = _present(row[f"before_{kind}_at"], row[f"before_{kind}_value"])
    after = _present(row[f"after_{kind}_at"], row[f"after_{kind}_value"])
    return sifting.envelope(_array(row["values"]), int(row["start"]), int(row["size"]), points, before, after)


def _with_context(blocks: DataFrame, keys: Sequence[str], store: bool) -> DataFrame:
    """Blocks with their extrema and neighbourhood; ``store`` writes the extrema once,
    for iterations, since the table feeds both the summary and the blocks."""
    marked = _with_extrema(blocks, keys)
    return _with_neighbours(materialize(marked) if store else marked, keys)


# --- single steps ----------------------------------------------------------------------


def extrema(df: DataFrame, spec: SeriesSpec, column: str = TARGET) -> DataFrame:
    """Local peaks and troughs of a series: (series, position, kind)."""
    marked = _with_extrema(to_blocks(df, spec, column), spec.keys)

    def turns(kind: str) -> Column:
        return F.transform(f"{kind}s", lambda at: F.struct(at.alias(spec.index), F.lit(kind).alias("kind")))

    return marked.select(*spec.keys, F.inline(F.concat(*map(turns, KINDS))))


def envelopes(df: DataFrame, spec: SeriesSpec, column: str = TARGET) -> DataFrame:
    """Upper and lower envelope per row."""
    context = _with_context(to_blocks(df, spec, column), spec.keys, store=False)
    fields = [T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("upper", "lower")]
    curves = _map_blocks(
        context,
        fields,
        lambda row: {"upper": _envelope(row, "peak"), "lower": _envelope(row, "trough")},
        drop=("peaks", "troughs", *NEIGHBOURS, *COUNTS),
    )
    zipped = curves.withColumn("values", F.arrays_zip("upper", "lower"))
    return from_blocks(zipped, spec, value="_e").select(*spec.keys, spec.index, "_e.upper", "_e.lower")


def _sift(blocks: DataFrame, keys: Sequence[str], store: bool) -> DataFrame:
    """Subtract the mean envelope once, where the series has enough extrema.

    The result carries its edges, so that a next sift need not read it for them.
    """

    def kernel(row: dict) -> dict:
        h = _array(row["values"])
        if min(row["n_peak"], row["n_trough"]) >= sifting.MIN_EXTREMA:
            h = h - (_envelope(row, "peak") + _envelope(row, "trough")) / 2
        return {"values": h} | _edges(h, int(row["start"]))

    context = _with_context(blocks, keys, store)
    return _map_blocks(context, [VALUES, *EDGES], kernel, drop=("peaks", "troughs", *NEIGHBOURS, *COUNTS))


def sift_once(df: DataFrame, spec: SeriesSpec, column: str = TARGET, output: str = "sifted") -> DataFrame:
    return from_blocks(_sift(to_blocks(df, spec, column), spec.keys, store=False), spec, value=output)


# --- decomposition ----------------------------------------------------------------------


#: Samples that a window shows beside its own at first, at least, and at most before its series goes sift by sift.
FIRST_HALO, MOST_HALO = 256, 65_536
#: The same for the windows of an ensemble, whose noise is sifted to its seventh mode in the window.
ENSEMBLE_HALO = 4_096


def _windows(
    blocks: DataFrame, keys: Sequence[str], width: int, halo: int, todo: DataFrame | None, carry: Sequence[str] = ()
) -> DataFrame:
    """Windows of ``width`` own samples and up to ``halo`` of their neighbours' on each side, from blocks.

    ``todo`` limits them to some numbers ``target`` of some series, and to the blocks ``wanted`` of
    each. A block is cut for every window that shows a part of it, so tables grow by about 2 * halo / width.
    Columns ``carry`` have one value in a series and stay; their windows are much work each, so they are dealt
    to a fixed number of tasks, whatever their size in bytes.
    """
    last = F.col("start") + F.size("values") - 1
    targets = F.sequence(
        F.greatest(F.floor((F.col("start") - halo) / width), F.lit(0)),
        F.least(F.floor((last + halo) / width), F.floor((F.col("size") - 1) / width)),
    )
    shown = blocks.select(*keys, *carry, "start", "size", "values", F.explode(targets).alias("target"))
    if todo is None:
        shown = shown.withColumn("wanted", F.lit(None).cast("array<bigint>"))
    else:
        shown = shown.join(todo, [*keys, "target"])
    low = F.greatest(F.col("start"), F.col("target") * width - halo)
    high = F.least(last + 1, (F.col("target") + 1) * width + halo)
    cut = F.slice("values", (low - F.col("start") + 1).cast("int"), F.greatest(high - low, F.lit(0)).cast("int"))
    part = F.struct(low.alias("low"), cut.alias("values")).alias("part")
    parts = shown.select(*keys, *carry, "target", "size", "wanted", part)
    if carry:
        tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = parts.repartition(tasks, *keys, "target")
    ordered = F.sort_array(F.collect_list("part"))
    grouped = parts.groupBy(*keys, "target", "size").agg(
        ordered.alias("_p"), *(F.first(c).alias(c) for c in ("wanted", *carry))
    )
    return grouped.select(
        *keys, *carry, "target", "size", "wanted", F.element_at("_p", 1)["low"].alias("low"),
        F.flatten(F.transform("_p", lambda p: p["values"])).alias("values"),
    )


def _proven_by_windows(
    blocks: DataFrame, keys: Sequence[str], block_rows: int, width: int, halo: int,
    own_part: Callable[[dict, tuple[int, int]], np.ndarray | None], carry: Sequence[str] = (),
) -> tuple[list[DataFrame], DataFrame | None]:
    """What a helper makes of the windows of signals, as blocks, and the blocks that stay unproven (None without any).

    The helper gives the samples of a window's own positions, or None where its halo did not suffice.
    There, blocks are looked at again in windows four times as long, with a halo four times as wide.
    """
    todo, found = None, []
    fields = [T.StructField("chunk", T.LongType()), T.StructField("start", T.LongType()), VALUES,
              T.StructField("proven", T.BooleanType())]
    while True:
        def kernel(row: dict, width: int = width) -> list[dict]:
            size = int(row["size"])
            own = int(row["target"]) * width, min((int(row["target"]) + 1) * width, size)
            made = own_part(row, own)
            starts = range(own[0], own[1], block_rows)
            if row["wanted"] is not None:
                starts = [int(k) * block_rows for k in sorted(row["wanted"])]
            return [
                {
                    "chunk": at // block_rows, "start": at, "proven": made is not None,
                    "values": None if made is None else made[at - own[0] : min(at + block_rows, own[1]) - own[0]],
                }
                for at in starts
            ]

        shown = _windows(blocks, keys, width, halo, todo, carry)
        done = materialize(_flat_map_blocks(shown, fields, kernel, drop=("target", "low", "wanted", *carry)))
        found.append(done.where("proven").drop("proven"))
        failed = done.where(~F.col("proven"))
        if failed.isEmpty():
            return found, None
        if 4 * halo > MOST_HALO:
            return found, failed
        width, halo = 4 * width, 4 * halo
        number = F.floor(F.col("start") / width).alias("target")
        todo = failed.groupBy(*keys, number).agg(F.collect_set("chunk").alias("wanted"))


def _modes_by_windows(blocks: DataFrame, keys: Sequence[str], block_rows: int) -> DataFrame:
    """First mode of long signals, all sifts of a window in its task.

    Every window checks that its halo sufficed. Series of which a part stays unproven at MOST_HALO go
    sift by sift.
    """

    def own_part(row: dict, own: tuple[int, int]) -> np.ndarray | None:
        made, low = sifting.proven_mode(_array(row["values"]), int(row["low"]), int(row["size"])) or (None, 0)
        at = int(row["low"]) + low
        return made[own[0] - at : own[1] - at] if made is not None and at <= own[0] and own[1] <= at + made.size else None

    found, failed = _proven_by_windows(blocks, keys, block_rows, block_rows, max(FIRST_HALO, block_rows // 8), own_part)
    if failed is None:
        return _union(found)
    unproven = failed.select(*keys).distinct()
    proven = _union(found).join(unproven, list(keys), "left_anti")
    rest = blocks.join(unproven, list(keys), "left_semi")
    for _ in range(sifting.SIFTS_PER_MODE):
        rest = materialize(_sift(rest, keys, store=True))
    return proven.unionByName(rest.drop(*EDGE_NAMES))


def first_modes(blocks: DataFrame, keys: Sequence[str], block_rows: int, split_series: bool) -> DataFrame:
    """First mode of every signal. Series of one block are finished within a task, longer
    ones in windows of their blocks."""
    one_block = F.col("size") <= block_rows
    small = _map_blocks(
        blocks.where(one_block), [VALUES], lambda row: {"values": sifting.first_mode(_array(row["values"]))}
    )
    if not split_series:
        return small
    return small.unionByName(_modes_by_windows(blocks.where(~one_block), keys, block_rows))


def _subtract(blocks: DataFrame, parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    other = parts.select(*keys, "chunk", F.col("values").alias("_part"))
    remaining = F.zip_with("values", "_part", lambda a, b: a - b)
    return blocks.join(other, [*keys, "chunk"]).withColumn("values", remaining).drop("_part")


def _with_going(blocks: DataFrame, keys: Sequence[str], split_series: bool) -> DataFrame:
    """Add ``going``: whether the series still has more than two extrema."""
    if not split_series:
        flag = [T.StructField("going", T.BooleanType())]
        return _map_blocks(blocks, flag, lambda row: {"going": sifting.is_oscillating(_array(row["values"]))})
    counted = _with_extrema(blocks, keys).groupBy(*keys).agg(
        (F.sum(F.size("peaks") + F.size("troughs")) > 2).alias("going")
    )
    return blocks.join(counted, list(keys))


def _has_split_series(blocks: DataFrame, block_rows: int) -> bool:
    return not blocks.where(F.col("size") > block_rows).isEmpty()


def _numbered(blocks: DataFrame, component: int) -> DataFrame:
    return blocks.withColumn("component", F.lit(component))


def _union(parts: list[DataFrame]) -> DataFrame:
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total


COMPONENT = T.StructField("component", T.IntegerType())


def decompose_blocks(blocks: DataFrame, keys: Sequence[str], block_rows: int, modes: int) -> DataFrame:
    """Sift out up to ``modes`` modes per signal; the rest is the residue.

    Signals of one block are decomposed within a task. Longer ones take one written table per
    mode where the halo of their windows suffices, and leave the loop once at most two extrema
    remain; the driver only asks whether any signal is left.
    """
    def kernel(row: dict) -> list[dict]:
        *found, rest = sifting.all_modes(_array(row["values"]), modes)
        numbered = [*enumerate(found, start=1), (RESIDUE, rest)]
        return [{"values": values, "component": component} for component, values in numbered]

    found = [_flat_map_blocks(blocks.where(F.col("size") <= block_rows), [VALUES, COMPONENT], kernel)]
    if not _has_split_series(blocks, block_rows):
        return found[0]
    current = blocks.where(F.col("size") > block_rows)
    for component in range(1, modes + 1):
        mode = materialize(first_modes(current, keys, block_rows, split_series=True))
        current = _settle(current, mode, keys, component, True, found)
        if current.isEmpty():
            return _union(found)
    found.append(_numbered(current, RESIDUE))
    return _union(found)


def _settle(
    current: DataFrame, mode: DataFrame, keys: Sequence[str], component: int, split_series: bool, found: list[DataFrame]
) -> DataFrame:
    """Record a mode and the residue of the signals that end with it; return what the
    other signals have left."""
    rest = materialize(_with_going(_subtract(current, mode, keys), keys, split_series))
    found.append(_numbered(mode, component))
    found.append(_numbered(rest.where(~F.col("going")).drop("going"), RESIDUE))
    return rest.where("going").drop("going")


def emd(df: DataFrame, spec: SeriesSpec, column: str = TARGET, max_imfs: int = 6) -> DataFrame:
    """Plain decomposition: at most ``max_imfs - 1`` modes and the residue, one row per
    (series, position, component)."""
    blocks = materialize(to_blocks(df, spec, column))
    parts = decompose_blocks(blocks, spec.keys, spec.block_rows, max_imfs - 1)
    return from_blocks(parts, spec, keep=["component"])


def _noise(blocks: DataFrame, spec: SeriesSpec, trials: int, seed: int) -> DataFrame:
    """One noise signal per series and trial, in the blocks of the series."""
    fanned = (
        blocks.drop("values")
        .withColumn(TRIAL, F.explode(F.sequence(F.lit(1), F.lit(trials))))
        .withColumn("_series", F.xxhash64(*[F.col(k) for k in spec.keys]))
        .withColumn("_n", F.least(F.col("size") - F.col("start"), F.lit(spec.block_rows)))
        .repartition(*spec.keys, TRIAL, "chunk")
    )

    def kernel(row: dict) -> dict:
        drawn = sifting.white_noise(seed, row["_series"], row[TRIAL], int(row["start"]), int(row["_n"]))
        return {"values": drawn}

    return _map_blocks(fanned, [VALUES], kernel, drop=("_series", "_n"))


def _spread(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Population standard deviation per series, from per-block sums."""

    def total(of: Callable[[Column], Column]) -> Column:
        return F.sum(F.aggregate("values", F.lit(0.0), lambda acc, v: acc + of(v)))

    moments = blocks.groupBy(*keys).agg(
        F.sum(F.size("values")).alias("_n"), total(lambda v: v).alias("_s"), total(lambda v: v * v).alias("_q")
    )
    variance = F.col("_q") / F.col("_n") - F.pow(F.col("_s") / F.col("_n"), F.lit(2))
    return moments.select(*keys, F.sqrt(F.greatest(variance, F.lit(0.0))).alias("_std"))


def _trial_mean(trials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean over the trials, block by block; a group is the trials of one block."""
    by = [*keys, *BLOCK]
    schema = T.StructType([*[trials.schema[c] for c in by], VALUES])

    def mean(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(TRIAL)
        out = ordered.iloc[:1][by].copy()
        out["values"] = [np.mean(np.stack(ordered["values"].to_list()), axis=0)]
        return out

    ship_package(trials.sparkSession)
    return trials.groupBy(*by).applyInPandas(mean, schema)


def ceemdan(
    df: DataFrame,
    spec: SeriesSpec,
    column: str = TARGET,
    max_imfs: int = 7,
    trials: int = 30,
    noise_scale: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Complete ensemble decomposition with adaptive noise (Torres et al., 2011).

    Mode k+1 is the mean, over the trials, of the first mode of the rest plus
    ``noise_scale`` times the rest's spread times mode k of that trial's noise (the noise
    itself at first). Like the usual implementation, it gives up to ``max_imfs + 1``
    modes before the residue. Windows are spread over the cluster and make the noise of all their
    trials themselves, so no table is longer than the signal; stages follow one another, each ending
    in a written table.
    """
    keys = spec.keys
    signal = materialize(to_blocks(df, spec, column))
    split_series = _has_split_series(signal, spec.block_rows)
    rest, found = signal, []
    for stage in range(max_imfs + 1):
        mode = _ensemble_modes(rest, spec, stage, trials, noise_scale, seed)
        rest = _settle(rest, mode, keys, stage + 1, split_series, found)
        if rest.isEmpty():
            return from_blocks(_union(found), spec, keep=["component"])
    found.append(_numbered(rest, RESIDUE))
    return from_blocks(_union(found), spec, keep=["component"])


def _ensemble_modes(
    rest: DataFrame, spec: SeriesSpec, stage: int, trials: int, noise_scale: float, seed: int
) -> DataFrame:
    """Mean first mode of the rest with mode ``stage`` of each trial's noise, by windows that prove their halo.

    Series of which a part stays unproven at MOST_HALO take a table of all trials.
    """
    keys = spec.keys
    halo, width = ENSEMBLE_HALO, spec.block_rows
    while width < 8 * halo:
        width *= 4
    # The spread of a series is laid on its blocks' numbers first, then blocks join by number.
    laid = rest.select(*keys, "chunk").join(_spread(rest, keys), keys)
    known = rest.join(laid, [*keys, "chunk"]).withColumn("_series", F.xxhash64(*[F.col(k) for k in keys]))

    def own_part(row: dict, own: tuple[int, int]) -> np.ndarray | None:
        return sifting.ensemble_mode(
            _array(row["values"]), int(row["low"]), int(row["size"]), own, row["_std"], stage, trials, noise_scale,
            seed, int(row["_series"]),
        )

    found, failed = _proven_by_windows(known, keys, spec.block_rows, width, halo, own_part, ("_std", "_series"))
    if failed is None:
        return _union(found)
    unproven = failed.select(*keys).distinct()
    proven = _union(found).join(unproven, list(keys), "left_anti")
    with passing_tables() as keep:
        slow = rest.join(unproven, list(keys), "left_semi")
        mode = keep(materialize(_ensemble_by_tables(slow, spec, stage, trials, noise_scale, seed)))
    return proven.unionByName(mode)


def _ensemble_by_tables(
    rest: DataFrame, spec: SeriesSpec, stage: int, trials: int, noise_scale: float, seed: int
) -> DataFrame:
    """The same along tables that hold every trial of every block, for series of any length and shape."""
    keys, with_trial = spec.keys, [*spec.keys, TRIAL]
    rest = materialize(rest)
    split_series = _has_split_series(rest, spec.block_rows)
    added = materialize(_noise(rest, spec, trials, seed))
    if stage:
        added = decompose_blocks(added, with_trial, spec.block_rows, stage).where(F.col("component") == stage)
    laid = rest.select(*keys, "chunk").join(_spread(rest, keys), keys)
    scaled = added.join(laid, [*keys, "chunk"]).select(
        *with_trial,
        "chunk",
        F.transform("values", lambda w: w * F.col("_std") * noise_scale).alias("_w"),
    )
    # Trials whose noise has no such mode left go on without noise.
    fanned = rest.withColumn(TRIAL, F.explode(F.sequence(F.lit(1), F.lit(trials))))
    disturbed = (
        fanned.join(scaled, [*with_trial, "chunk"], "left")
        .withColumn(
            "values",
            F.when(F.col("_w").isNull(), F.col("values")).otherwise(F.zip_with("values", "_w", lambda x, w: x + w)),
        )
        .drop("_w")
    )
    return _trial_mean(first_modes(materialize(disturbed), with_trial, spec.block_rows, split_series), keys)


def attach_modes(df: DataFrame, modes: DataFrame, spec: SeriesSpec, count: int) -> DataFrame:
    """Append ``imf_1`` ... ``imf_<count>`` and ``imf_residue`` as columns; NULL where a
    series has fewer modes."""
    names = {f"imf_{k}": k for k in range(1, count + 1)} | {"imf_residue": RESIDUE}
    wide = modes.groupBy(*spec.keys, spec.index).agg(
        *[F.max(F.when(F.col("component") == k, F.col("value"))).alias(n) for n, k in names.items()]
    )
    return df.join(wide, [*spec.keys, spec.index], "left")
