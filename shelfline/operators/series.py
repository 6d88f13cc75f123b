"""Windows over ordered series: the machinery behind lags, rolling and expanding statistics and promo clocks.

A *feature* says which columns it adds; ``add_series_features`` decides how the rows are spread:

* Series of moderate length are windowed as they are: one shuffle by the series key serves every feature.
* Series longer than ``spark.shelfline.maxGroupRows`` (one hot key, or no group columns at all) are cut into chunks of
  consecutive rows. Features with a bounded reach borrow the neighbouring rows of the next chunk; running features add
  the state carried over from all earlier chunks. The result is the same, and no task sees a whole series.

Rows whose group key is NULL belong to no series: they get NULL features and are spread over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators.relational import fits_broadcast
from shelfline.schemas import as_date, nan_to_null, require_columns
from shelfline.session import MAX_GROUP_ROWS, int_setting, written

#: Number of a row within its series, while features are computed.
POSITION = "_pos"
_LANE, _HASH, _RID = "_lane", "_row_hash", "_rid"
_PART, _CHUNK, _HOME = "_part", "_chunk", "_home"
_NULL_KEY_LANES = 1024
#: Rows of a range that are numbered by one task, if a chunk holds less: numbering streams over sorted rows and keeps none.
_RANGE_ROWS = 50_000
#: Rows that a task windows, if series are short enough: sorted rows and their features are held in memory.
_TASK_ROWS = 250_000

#: Statistics by name, for fixed frames (UDF-2).
STATS: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "max": F.max,
    "min": F.min,
    "sum": F.sum,
}


def statistic(name: str) -> Callable[[Column], Column]:
    if name not in STATS:
        raise ValueError(f"unknown statistic {name!r}; expected one of {sorted(STATS)}")
    return STATS[name]


# --- Features -------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class BoundedFeature:
    """A column computed from rows at most ``back`` before and ``ahead`` after the current one.

    With a ``guard`` (a boolean helper column, shared by features of one frame) the value is NULL unless it holds.
    """

    name: str
    back: int
    ahead: int
    build: Callable[[WindowSpec], Column]
    guard: BoundedFeature | None = None


@dataclass(frozen=True)
class RunningState:
    """One value carried from chunk to chunk: how a chunk is summarised and how the summaries of several combine."""

    summary: Callable[[], Column]
    combine: Callable[[Column], Column]
    reverse: bool = False


@dataclass(frozen=True)
class RunningFeature:
    """A column computed from all rows up to (or, when reversed, from) the current one.

    ``inputs`` are bounded helper columns; ``states`` the values carried between chunks; ``build`` gets the running
    window, the reversed running window and the carried values (NULL for the first chunk, or when nothing was cut).
    """

    name: str
    build: Callable[[WindowSpec, WindowSpec, Callable[[str], Column | None]], Column]
    inputs: tuple[BoundedFeature, ...] = ()
    states: dict[str, RunningState] = field(default_factory=dict, hash=False)


def lag_feature(column: str, offset: int, name: str | None = None) -> BoundedFeature:
    """WIN-1: the value ``offset`` rows earlier (later when negative)."""
    return BoundedFeature(
        name or f"{column}_lag_{offset}",
        back=max(offset, 0),
        ahead=max(-offset, 0),
        build=lambda w: F.lag(column, offset).over(w),
    )


def rolling_feature(column: str, shift: int, width: int, stat: str) -> BoundedFeature:
    """WIN-2: a statistic of ``width`` rows that end ``shift`` rows earlier; NULL unless all of them hold a value."""
    aggregate = statistic(stat)
    reach = {"back": max(shift + width - 1, 0), "ahead": max(-shift, 0)}

    def frame(w: WindowSpec) -> WindowSpec:
        return w.rowsBetween(-(shift + width - 1), -shift)

    full = BoundedFeature(
        f"_{column}_full{width}_lag{shift}", build=lambda w: F.count(column).over(frame(w)) == width, **reach
    )
    return BoundedFeature(
        f"{column}_roll{width}_{stat}_lag{shift}",
        build=lambda w: aggregate(F.col(column).cast("double")).over(frame(w)),
        guard=full,
        **reach,
    )


def expanding_feature(column: str, shift: int, stat: str) -> RunningFeature:
    """WIN-3: a statistic of all rows up to ``shift`` rows earlier; one value is enough, NULLs are skipped."""
    aggregate = statistic(stat)
    shifted = f"_{column}_shift{shift}"
    value = F.col(shifted).cast("double")

    def build(run: WindowSpec, _: WindowSpec, carried: Callable[[str], Column | None]) -> Column:
        here = aggregate(value).over(run)
        if stat in ("max", "min"):
            before = carried(f"{shifted}_{stat}")
            return here if before is None else (F.greatest if stat == "max" else F.least)(before, here)
        n0, s0, m0 = (carried(f"{shifted}_{part}") for part in ("count", "sum", "m2"))
        if n0 is None:
            return here
        n0, s0, m0 = F.coalesce(n0, F.lit(0)), F.coalesce(s0, F.lit(0.0)), F.coalesce(m0, F.lit(0.0))
        n1 = F.count(value).over(run)
        s1 = F.coalesce(F.sum(value).over(run), F.lit(0.0))
        n = n0 + n1
        if stat == "sum":
            return F.when(n > 0, s0 + s1)
        if stat == "mean":
            return F.when(n > 0, (s0 + s1) / n)
        m1 = F.coalesce(F.var_pop(value).over(run), F.lit(0.0)) * n1
        gap = F.coalesce(F.try_divide(s1, n1) - F.try_divide(s0, n0), F.lit(0.0))
        m2 = m0 + m1 + F.coalesce(F.try_divide(gap * gap * n0 * n1, n), F.lit(0.0))
        return F.when(n > 1, F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - 1)))

    if stat in ("max", "min"):
        extreme = F.max if stat == "max" else F.min
        states = {f"{shifted}_{stat}": RunningState(lambda: extreme(value), extreme)}
    else:
        states = {
            f"{shifted}_count": RunningState(lambda: F.count(value), F.sum),
            f"{shifted}_sum": RunningState(lambda: F.sum(value), F.sum),
        }
        # The spread around the mean is combined in ``_carried_states``: it needs count and sum as well.
        states[f"{shifted}_m2"] = RunningState(lambda: F.var_pop(value) * F.count(value), F.sum)
    return RunningFeature(
        f"{column}_exp_{stat}_lag{shift}", build, (lag_feature(column, shift, name=shifted),), states
    )


# --- Spreading ------------------------------------------------------------------------------------------------------


def add_series_features(
    df: DataFrame,
    features: Iterable[BoundedFeature | RunningFeature],
    group_cols: Sequence[str] | None,
    *,
    date_col: str = "date",
    tiebreak: Sequence[str] = (),
    rows_per_group: str = "check",
    scratch: dict[str, Column] | None = None,
) -> DataFrame:
    """Add the features to every row of ``df``.

    ``tiebreak`` orders rows of one series and date. ``rows_per_group="daily"`` states that a series has one row per
    day, so that its length is bounded by the calendar; ``"check"`` counts the rows per group first and cuts the long
    ones. ``scratch`` are helper columns the features read; they are dropped at the end.
    """
    if rows_per_group not in ("check", "daily"):
        raise ValueError("rows_per_group must be 'check' or 'daily'")
    keys = list(group_cols or [])
    require_columns(df, [*keys, date_col, *tiebreak], "series features")
    # One NaN would spoil every later row of a running statistic.
    df = nan_to_null(df)
    features = list(features)
    names = [f.name for f in features]
    kept = [c for c in df.columns if c not in names]
    df = as_date(df, date_col)
    order = [date_col, *tiebreak]
    if scratch:
        df = df.withColumns(scratch)

    limit = int_setting(df.sparkSession, MAX_GROUP_ROWS)
    if rows_per_group == "daily" and keys:
        return _whole_series(df, features, keys, order).select(*kept, *names)

    # Without a promise of unique dates, equal sort keys are ordered by the row's content: a fixed order on any run.
    hashed = [c.name for c in df.schema.fields if not isinstance(c.dataType, (T.MapType, T.VariantType))]
    df = df.withColumn(_HASH, F.xxhash64(*hashed))
    order.append(_HASH)
    if not keys:
        long_rows, short_rows = (df, None) if df.count() > limit else (None, df)
    else:
        counts = df.where(all_known(keys)).groupBy(*keys).count().where(F.col("count") > limit)
        # There are at most rows/limit long series, so this table is small against the rows it selects.
        long_keys = written(counts.select(*keys), "long-series")
        if not long_keys.isEmpty():
            if fits_broadcast(long_keys):
                long_keys = F.broadcast(long_keys)
            long_rows = df.join(long_keys, keys, "left_semi")
            short_rows = df.join(long_keys, keys, "left_anti")
        else:
            long_rows, short_rows = None, df

    parts = []
    if short_rows is not None:
        parts.append(_whole_series(short_rows, features, keys, order).select(*kept, *names))
    if long_rows is not None:
        parts.append(_cut_series(long_rows, features, keys, order, limit).select(*kept, *names))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def all_known(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return known


def bounded_inputs(features: Sequence[BoundedFeature | RunningFeature]) -> dict[str, BoundedFeature]:
    """Bounded columns to compute first, by name: the bounded features and what the running ones read."""
    found: dict[str, BoundedFeature] = {}
    for feature in features:
        for bounded in (feature,) if isinstance(feature, BoundedFeature) else feature.inputs:
            found[bounded.name] = bounded
            if bounded.guard is not None:
                found[bounded.guard.name] = bounded.guard
    return found


def guarded_columns(features: Sequence[BoundedFeature | RunningFeature]) -> dict[str, Column]:
    """Final form of the guarded features, once their helper columns exist."""
    return {
        f.name: F.when(F.col(f.guard.name), F.col(f.name))
        for f in features
        if isinstance(f, BoundedFeature) and f.guard is not None
    }


def spread_series(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by series to as many tasks as keep each at about ``_TASK_ROWS`` rows, however large the table is.

    The number is a multiple of the shuffle's partitions, so that tasks divide the buckets that its hash makes. Small tables are
    left to Spark, which deals them out by their size.
    """
    n_rows = df.select(*keys).count()
    if n_rows <= _TASK_ROWS:
        return df
    unit = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(unit * math.ceil(n_rows / (_TASK_ROWS * unit)), *keys)


def _whole_series(df: DataFrame, features: Sequence, keys: list[str], order: list[str]) -> DataFrame:
    """One window partition per series. All windows share the partitioning, so they share one shuffle."""
    running = [f for f in features if isinstance(f, RunningFeature)]
    known = all_known(keys)
    # Rows without a key get no features, so it does not matter with which others they meet.
    lane = F.when(~known, F.pmod(F.monotonically_increasing_id(), F.lit(_NULL_KEY_LANES)).cast("int"))
    df = spread_series(df.withColumn(_LANE, lane), [*keys, _LANE]) if keys else df
    partition = [*keys, _LANE] if keys else [F.lit(0)]
    asc = Window.partitionBy(*partition).orderBy(*order)
    desc = Window.partitionBy(*partition).orderBy(*[F.col(c).desc() for c in order])

    columns = {name: f.build(asc) for name, f in bounded_inputs(features).items()}
    if running:
        columns[POSITION] = F.row_number().over(asc).cast("long")
    df = df.withColumns(columns)
    run = asc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rev = desc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = {f.name: f.build(run, rev, lambda _: None) for f in running} | guarded_columns(features)
    df = df.withColumns(later) if later else df
    if keys:
        df = df.withColumns({f.name: F.when(known, F.col(f.name)) for f in features})
    return df


def _ranges(spark: SparkSession, n_rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_rows / _RANGE_ROWS))


def with_positions(df: DataFrame, keys: list[str], order: list[str], rows_per_part: int) -> DataFrame:
    """Number the rows of every series (1, 2, ...) without bringing a series into one task.

    The rows are written with an id that makes their order total, cut into ranges of that order, and written again:
    the range borders are sampled, so they must be fixed before two queries read them. However short the chunks are,
    there are no more ranges than the shuffle has partitions, or than ``_RANGE_ROWS`` asks for.
    """
    rows = written(df.withColumn(_RID, F.monotonically_increasing_id()), "series-rows")
    n_rows = rows.count()
    n_parts = max(1, min(math.ceil(n_rows / rows_per_part), _ranges(df.sparkSession, n_rows)))
    total_order = [*keys, *order, _RID]
    cut = written(
        rows.repartitionByRange(n_parts, *total_order).withColumn(_PART, F.spark_partition_id()), "series-parts"
    )
    sizes = cut.groupBy(*keys, _PART).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # One row per series and range: as many rows as there are ranges and long series.
    starts = sizes.select(*keys, _PART, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys, _PART).orderBy(*order, _RID)
    return (
        cut.join(starts, [*keys, _PART])
        .withColumn(POSITION, F.row_number().over(within) + F.col("_start"))
        .drop("_start", _PART, _RID)
    )


def _cut_series(df: DataFrame, features: Sequence, keys: list[str], order: list[str], limit: int) -> DataFrame:
    """Windows over chunks of consecutive rows, with borrowed neighbours and carried state."""
    running = [f for f in features if isinstance(f, RunningFeature)]
    inputs = bounded_inputs(features)
    back = max([f.back for f in inputs.values()], default=0)
    ahead = max([f.ahead for f in inputs.values()], default=0)
    size = max(limit, back, ahead, 1)

    rows = with_positions(df, keys, order, size)
    own = F.floor((F.col(POSITION) - 1) / size)
    place = F.pmod(F.col(POSITION) - 1, F.lit(size))
    homes = F.array(
        own,
        F.when(place >= size - back, own + 1) if back else F.lit(None).cast("long"),
        F.when((place < ahead) & (own > 0), own - 1) if ahead else F.lit(None).cast("long"),
    )
    chunked = rows.withColumn(_CHUNK, F.explode(F.array_compact(homes))).withColumn(_HOME, F.col(_CHUNK) == own)
    asc = Window.partitionBy(*keys, _CHUNK).orderBy(POSITION)
    desc = Window.partitionBy(*keys, _CHUNK).orderBy(F.col(POSITION).desc())
    bounded = chunked.withColumns({name: f.build(asc) for name, f in inputs.items()}).where(F.col(_HOME))
    guarded = guarded_columns(features)
    bounded = bounded.withColumns(guarded) if guarded else bounded
    if not running:
        return bounded

    states = {name: state for f in running for name, state in f.states.items()}
    carried = _carried_states(bounded, states, keys)
    run = asc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rev = desc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = bounded.join(carried, [*keys, _CHUNK], "left")
    return joined.withColumns({f.name: f.build(run, rev, lambda s: F.col(f"_before_{s}")) for f in running})


def _carried_states(rows: DataFrame, states: dict[str, RunningState], keys: list[str]) -> DataFrame:
    """Per chunk, the state of all earlier (or later) chunks: one row per chunk, combined in a window over chunks."""
    chunks = rows.groupBy(*keys, _CHUNK).agg(*[s.summary().alias(name) for name, s in states.items()])
    partition = keys or [F.lit(0)]
    before = Window.partitionBy(*partition).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*partition).orderBy(F.col(_CHUNK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    columns = []
    for name, state in states.items():
        frame = after if state.reverse else before
        combined = state.combine(F.col(name)).over(frame)
        if name.endswith("_m2"):
            # Spread within the chunks plus the spread of their means around the common mean.
            n, s = F.col(name[:-2] + "count"), F.col(name[:-2] + "sum")
            center = F.try_divide(F.sum(s).over(Window.partitionBy(*partition)), F.sum(n).over(Window.partitionBy(*partition)))
            off = F.coalesce(F.try_divide(s, n) - center, F.lit(0.0))
            total_n, total_s = F.sum(n).over(frame), F.sum(s).over(frame)
            mean_off = F.coalesce(F.try_divide(total_s, total_n) - center, F.lit(0.0))
            combined = combined + F.sum(n * off * off).over(frame) - total_n * mean_off * mean_off
        columns.append(combined.alias(f"_before_{name}"))
    return chunks.select(*keys, _CHUNK, *columns)


# --- Operators ------------------------------------------------------------------------------------------------------


def make_lag(
    df: DataFrame, core_column: str, lag: Sequence[int] = (1,), group_cols: Sequence[str] | None = None, **spread
) -> DataFrame:
    """WIN-1: ``{col}_lag_{k}`` for every offset, counted in rows of the series."""
    return add_series_features(df, [lag_feature(core_column, k) for k in lag], group_cols, **spread)


def make_rolling(
    df: DataFrame,
    core_column: str,
    rollag: Sequence[int] = (1,),
    window: Sequence[int] = (7,),
    rolling_stats: Sequence[str] = ("mean", "std", "max", "min", "sum"),
    group_cols: Sequence[str] | None = None,
    **spread,
) -> DataFrame:
    """WIN-2: ``{col}_roll{w}_{stat}_lag{v}`` for every statistic, shift and width."""
    features = [rolling_feature(core_column, v, w, stat) for stat in rolling_stats for v in rollag for w in window]
    return add_series_features(df, features, group_cols, **spread)


def make_expanding(
    df: DataFrame,
    core_column: str,
    explag: Sequence[int] = (1,),
    exp_stats: Sequence[str] = ("mean", "std", "max", "min", "sum"),
    group_cols: Sequence[str] | None = None,
    **spread,
) -> DataFrame:
    """WIN-3: ``{col}_exp_{stat}_lag{v}`` for every statistic and shift."""
    features = [expanding_feature(core_column, v, stat) for stat in exp_stats for v in explag]
    return add_series_features(df, features, group_cols, **spread)


def first_rows(df: DataFrame, n: int, keys: Sequence[str], date_col: str = "date") -> DataFrame:
    """SRC-4: the first ``n`` rows by date and key, equal ones by their content: one pass, of which every task keeps its first ``n``."""
    hashed = [c.name for c in df.schema.fields if not isinstance(c.dataType, (T.MapType, T.VariantType))]
    return df.orderBy(date_col, *keys, F.xxhash64(*hashed)).limit(n)
