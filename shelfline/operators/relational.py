"""Key handling, deduplication and many-to-one joins."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.session import BROADCAST_MAX_BYTES, int_setting, written

#: Column that carries the row order of a source file (see ``sources.tables.with_source_order``).
SOURCE_ORDER = "_source_order"

#: Places to which fact rows without a key are dealt in a shuffled join.
SPREAD = 1024
_SPREAD = "_spread"


def resolve_group_cols(df: DataFrame, group_cols: Sequence[str] | None) -> list[str]:
    """PRJ-4: the group columns that exist in ``df``; the others are warned about."""
    wanted = list(group_cols or [])
    present = [c for c in wanted if c in df.columns]
    absent = [c for c in wanted if c not in df.columns]
    if absent:
        warnings.warn(f"group columns {absent} are missing; using {present or 'no grouping'}", stacklevel=2)
    return present


def keep_one(
    df: DataFrame, keys: Sequence[str], *, keep: str = "first", order_by: Sequence[str] | None = None
) -> DataFrame:
    """AGG-9: one row per key, the first or the last in an explicit order.

    The order is ``order_by``, else the order of the source file when it was kept, else the remaining columns' values.
    The extreme of a struct combines on the map side, so a key that holds most of the rows sends one row per task.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = list(order_by or ([SOURCE_ORDER] if SOURCE_ORDER in rest else rest))
    # Remaining columns close the order, so that equal sort keys still give one fixed row.
    closing = [c for c in rest if c not in order]
    extreme = F.min if keep == "first" else F.max
    if all(_orderable(df, c) for c in closing):
        row = extreme(F.struct(*order, *closing))
    else:
        pick = F.min_by if keep == "first" else F.max_by
        row = pick(F.struct(*order, *closing), F.struct(*order, *[c for c in closing if _orderable(df, c)]))
    chosen = df.groupBy(*keys).agg(row.alias("_row"))
    return chosen.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def _orderable(df: DataFrame, column: str) -> bool:
    return not isinstance(df.schema[column].dataType, (T.MapType, T.VariantType))


def measured_bytes(df: DataFrame) -> int:
    """Size of a table by one aggregate over it: fixed widths times rows, plus the bytes its strings hold."""
    fixed = 0
    variable: list[Column] = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            fixed += 8
            variable.append(F.coalesce(F.sum(F.octet_length(F.col(field.name)).cast("long")), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            # As long as it is spelled out, which is no less than the bytes of most values; 16 more for each row.
            fixed += 16
            variable.append(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(F.col(field.name)))).cast("long")), F.lit(0)))
        else:
            fixed += 16
    total = F.count(F.lit(1)) * F.lit(fixed)
    for part in variable:
        total = total + part
    return int(df.agg(total.alias("bytes")).first()["bytes"])


def fits_broadcast(dim: DataFrame) -> bool:
    """Whether the measured size of ``dim`` is under the engine's broadcast limit."""
    return measured_bytes(dim) <= int_setting(dim.sparkSession, BROADCAST_MAX_BYTES)


def attach(fact: DataFrame, dim: DataFrame, on: Sequence[str], *, small: bool) -> DataFrame:
    """JOIN-7: many-to-one left join on ``on``; ``dim`` must hold one row per key.

    ``small`` states that the size of ``dim`` was measured or is bounded by the calendar. Otherwise both sides are shuffled: Spark
    splits hot keys of the fact side at run time, and rows without a key, which match nothing, are spread by their content.
    """
    on = list(on)
    if small:
        return fact.join(F.broadcast(dim), on, "left")
    missing = F.lit(False)
    for key in on:
        missing = missing | F.col(key).isNull()
    content = [c for c in fact.columns if _orderable(fact, c)]
    spread = F.when(missing, F.pmod(F.xxhash64(*content), F.lit(SPREAD)).cast("int")).otherwise(F.lit(0))
    # Always 0, but no constant: a constant would be taken out of the join's keys.
    home = F.pmod(F.xxhash64(*on), F.lit(1)).cast("int")
    joined = fact.withColumn(_SPREAD, spread).join(dim.withColumn(_SPREAD, home), [*on, _SPREAD], "left")
    return joined.drop(_SPREAD)


def attach_measured(fact: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """``attach`` of a dimension whose size nothing bounds: it is written once, measured, and then broadcast or shuffled."""
    stored = written(dim, "dimension")
    return attach(fact, stored, on, small=fits_broadcast(stored))


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """JOIN-7 for sides that are not deduplicated first: a repeated key is an error, as in a checked merge."""
    repeated = df.groupBy(*keys).count().where("count > 1").limit(1)
    if not repeated.isEmpty():
        raise ValueError(f"{what}: key {list(keys)} is not unique")


def aligned(df: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """PRJ-10: cast the join keys of ``df`` to the types they have in ``reference``."""
    casts = {
        k: F.col(k).cast(reference.schema[k].dataType)
        for k in keys
        if df.schema[k].dataType != reference.schema[k].dataType
    }
    return df.withColumns(casts) if casts else df
