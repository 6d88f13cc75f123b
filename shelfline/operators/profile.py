"""AGG-10 and SNK-5: the profile of a feature table and its column catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.schemas import numeric


#: Size of the sketches of distinct values: 2 to this power registers, for an error of about 1.6 %.
SKETCH_BITS = 12


def feature_catalogue(df: DataFrame) -> DataFrame:
    """SNK-5: position, name and type of every column."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")


def check_features(df: DataFrame, target: str | None = None, topk: int | None = None) -> DataFrame:
    """AGG-10: rows ``section, name, value`` that describe a feature table.

    Sections: ``shape``, ``dtype`` (columns per type), ``null_ratio`` (all, or the ``topk`` highest), ``constant`` (columns of
    one state, NULL counting as a state), ``cardinality`` (of text columns, likewise) and ``target``.
    One aggregate gives all sections but the cardinalities, which are counted by a second one. A column is constant when its extremes meet, which needs no distinct count;
    exact cardinalities are counted for text columns only, after their values were combined on the map side.
    """
    fields = df.schema.fields
    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        c = F.col(f.name)
        measures.append(F.count(c).alias(f"_known{i}"))
        if _comparable(f.dataType):
            measures += [F.min(c).alias(f"_min{i}"), F.max(c).alias(f"_max{i}")]
    if target is not None and target in df.columns:
        t = F.col(target).try_cast("double")
        t = F.when(~F.isnan(t), t)
        measures += [
            F.count(t).cast("double").alias("_t_count"),
            F.count_if(t.isNull()).cast("double").alias("_t_nulls"),
            F.avg(t).alias("_t_mean"),
            F.stddev_samp(t).alias("_t_std"),
        ]
    parts = [_report(df.agg(*measures), fields, topk)]

    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    if texts:
        values = (
            df.select(*texts)
            .unpivot([], texts, "name", "v")
            .groupBy("name", "v")
            .agg(F.lit(1).alias("_one"))
            .groupBy("name")
            .agg(F.count(F.lit(1)).cast("double").alias("value"))
        )
        cardinality = values.select(F.lit("cardinality").alias("section"), "name", "value")
        parts.append(cardinality if topk is None else cardinality.orderBy(F.desc("value"), "name").limit(topk))

    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _report(wide: DataFrame, fields: list[T.StructField], topk: int | None) -> DataFrame:
    """The lines that follow from one row of measures."""

    def line(section: str, name: str, value) -> Column:
        return F.struct(
            F.lit(section).alias("section"), F.lit(name).alias("name"), value.cast("double").alias("value")
        )

    rows = F.col("_rows")
    shape = [line("shape", "rows", rows), line("shape", "columns", F.lit(len(fields)))]
    kinds: dict[str, int] = {}
    for f in fields:
        kinds[f.dataType.simpleString()] = kinds.get(f.dataType.simpleString(), 0) + 1
    shape += [line("dtype", kind, F.lit(n)) for kind, n in kinds.items()]
    constants, nulls = [], []
    for i, f in enumerate(fields):
        known = F.col(f"_known{i}")
        nulls.append(F.struct((-F.try_divide(rows - known, rows)).alias("down"), F.lit(f.name).alias("name")))
        if _comparable(f.dataType):
            one_value = (known == rows) & F.col(f"_min{i}").eqNullSafe(F.col(f"_max{i}"))
            constants.append(F.when((known == 0) | one_value, line("constant", f.name, F.lit(1))))
    if "_t_count" in wide.columns:
        shape += [line("target", name, F.col(f"_t_{name}")) for name in ("count", "nulls", "mean", "std")]

    # One row of numbers becomes the few lines of the report; the top null ratios are picked among the columns.
    highest = F.transform(
        F.slice(F.array_sort(F.array(*nulls)), 1, len(fields) if topk is None else topk),
        lambda n: F.struct(F.lit("null_ratio").alias("section"), n["name"].alias("name"), (-n["down"]).alias("value")),
    )
    lines = F.concat(F.array_compact(F.array(*shape, *constants)), highest)
    return wide.select(F.explode(lines).alias("_l")).select("_l.*")


def profile_states(df: DataFrame, target: str | None = None, by: str = "date") -> DataFrame:
    """Mergeable measures of every day: counts, extremes, moments of the target, and a sketch of each text column's values.

    A profile of any range of days follows from them (``profile_from_states``), so that a new day costs one day.
    """
    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        measures.append(F.count(c).alias(f"_known{i}"))
        if _comparable(f.dataType):
            measures += [F.min(c).alias(f"_min{i}"), F.max(c).alias(f"_max{i}")]
        if isinstance(f.dataType, T.StringType):
            measures.append(F.hll_sketch_agg(c, SKETCH_BITS).alias(f"_values{i}"))
    if target is not None and target in df.columns:
        t = F.col(target).try_cast("double")
        t = F.when(~F.isnan(t), t)
        measures += [
            F.count(t).alias("_t_known"),
            F.coalesce(F.sum(t), F.lit(0.0)).alias("_t_sum"),
            F.coalesce(F.var_pop(t) * F.count(t), F.lit(0.0)).alias("_t_m2"),
        ]
    return df.groupBy(F.col(by).alias("_day")).agg(*measures)


def profile_from_states(states: DataFrame, fields: list[T.StructField], topk: int | None = None) -> DataFrame:
    """AGG-10 from the states of some days: the lines of ``check_features``, with estimated cardinalities."""
    merged = [F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows")]
    texts = []
    for i, f in enumerate(fields):
        merged.append(F.coalesce(F.sum(f"_known{i}"), F.lit(0)).alias(f"_known{i}"))
        if _comparable(f.dataType):
            merged += [F.min(f"_min{i}").alias(f"_min{i}"), F.max(f"_max{i}").alias(f"_max{i}")]
        if isinstance(f.dataType, T.StringType):
            merged.append(F.hll_sketch_estimate(F.hll_union_agg(f"_values{i}")).alias(f"_values{i}"))
            texts.append((i, f.name))
    if "_t_known" in states.columns:
        n, total = F.col("_t_known"), F.col("_t_sum")
        mean = F.try_divide(F.sum(total), F.sum(n))
        # Spread within the days, and of their means around the common mean.
        between = F.sum(F.coalesce(F.try_divide(total * total, n), F.lit(0.0))) - F.coalesce(F.try_divide(F.sum(total) * F.sum(total), F.sum(n)), F.lit(0.0))
        spread = F.sum("_t_m2") + F.greatest(between, F.lit(0.0))
        merged += [
            F.coalesce(F.sum(n), F.lit(0)).cast("double").alias("_t_count"),
            (F.coalesce(F.sum("_rows"), F.lit(0)) - F.coalesce(F.sum(n), F.lit(0))).cast("double").alias("_t_nulls"),
            mean.alias("_t_mean"),
            F.sqrt(F.try_divide(spread, F.when(F.sum(n) > 1, F.sum(n) - 1))).alias("_t_std"),
        ]
    wide = states.agg(*merged)
    out = _report(wide, fields, topk)
    if texts:
        # A missing value counts as one more state.
        lines = [
            F.struct(
                F.lit("cardinality").alias("section"), F.lit(name).alias("name"),
                (F.col(f"_values{i}") + F.when(F.col(f"_known{i}") < F.col("_rows"), 1).otherwise(0)).cast("double").alias("value"),
            )
            for i, name in texts
        ]
        known = wide.where("_rows > 0").select(F.explode(F.array(*lines)).alias("_l")).select("_l.*")
        out = out.unionByName(known if topk is None else known.orderBy(F.desc("value"), "name").limit(topk))
    return out


def _comparable(data_type: T.DataType) -> bool:
    return numeric(data_type) or isinstance(
        data_type, (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
    )
