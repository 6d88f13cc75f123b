"""STR-3, MAP-1 to MAP-3, AGG-5, AGG-6, JOIN-5 and JOIN-6: the holiday calendar and its scoped join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.text import parse_descriptions
from shelfline.operators.relational import aligned, attach, fits_broadcast, require_unique
from shelfline.schemas import as_date, require_columns
from shelfline.session import written

HOLIDAY_FLAGS = ["is_holiday", "holiday_duration", "is_day_off", "is_event"]

# The columns a holiday table drops once its features exist.
CONSUMED = ["type", "scope_name", "description", "transferred", "anchor_label"]

# Holiday scopes, and the column of a sales row that names the place of the narrower ones.
PLACES = {"regional": "state", "local": "city"}
SCOPES = ["national", *PLACES]


def clean(holidays: DataFrame) -> DataFrame:
    """STR-3: rename the locale columns and parse the description."""
    require_columns(holidays, ["date", "type", "locale", "locale_name", "description"], "clean")
    df = as_date(holidays).withColumnsRenamed({"locale": "scope", "locale_name": "scope_name"})
    return parse_descriptions(df)


def add_business(holidays: DataFrame) -> DataFrame:
    """MAP-1: the city of a local holiday, the state of a regional one."""
    return holidays.withColumns(
        {
            "city": F.when(F.col("scope") == "Local", F.col("scope_name")),
            "state": F.when(F.col("scope") == "Regional", F.col("scope_name")),
        }
    )


def add_features(holidays: DataFrame) -> DataFrame:
    """MAP-2 and AGG-5: flags, and the length of a holiday as the span of its day offsets."""
    role = F.col("role")
    flagged = holidays.withColumns(
        {
            "is_national": F.coalesce(F.col("scope") == "National", F.lit(False)),
            "is_holiday": role == "holiday",
            "is_event": role == "event",
            "is_day_off": ((role == "holiday") & ~F.coalesce(F.col("transferred"), F.lit(False)))
            | role.isin("transfer", "bridge"),
        }
    )
    offset = F.col("offset_days")
    spans = holidays.groupBy("anchor_key").agg((F.max(offset) - F.min(offset) + 1).alias("holiday_duration"))
    # A key is no longer than the description it was cut from, which is cheaper to measure.
    source = "description" if "description" in holidays.columns else "anchor_key"
    joined = attach(flagged, spans, ["anchor_key"], small=fits_broadcast(holidays.select(source)))
    return joined.select(*flagged.columns, "holiday_duration")


def drop_consumed(holidays: DataFrame) -> DataFrame:
    """PRJ-5."""
    return holidays.drop(*CONSUMED)


def preprocess(holidays: DataFrame) -> DataFrame:
    """MAP-3: the whole holiday preparation."""
    return holidays.transform(clean).transform(add_business).transform(add_features).transform(drop_consumed)


def scope_flags(holidays: DataFrame) -> DataFrame:
    """AGG-6: one row per date and place a holiday applies to; flags are OR-ed and the longest duration wins.

    The place is that of the scope: the whole country, a state or a city. Rows without a date or place are left out.
    """
    scope = F.lower("scope")
    place = F.when(scope == "national", F.lit(""))
    for name, column in PLACES.items():
        place = place.when(scope == name, F.col(column))
    flags = [F.max(F.coalesce(F.col(c).cast("int"), F.lit(0))).alias(c) for c in HOLIDAY_FLAGS]
    return (
        holidays.select("date", scope.alias("scope"), place.alias("place"), *HOLIDAY_FLAGS)
        .where(F.col("date").isNotNull() & F.col("place").isNotNull())
        .groupBy("date", "scope", "place")
        .agg(*flags)
    )


def merge_train(train: DataFrame, holidays: DataFrame, stores: DataFrame, *, validate: bool = True) -> DataFrame:
    """JOIN-5: the sales table with four holiday features, taken over the national, regional and local scope.

    City and state come from ``stores`` when the table lacks them (JOIN-6) and do not stay in the result.
    """
    require_columns(train, ["date", "store_nbr"], "merge_train")
    train = as_date(train)
    out = train
    borrowed = [c for c in ("city", "state") if c not in train.columns]
    if borrowed:
        places = aligned(stores.select("store_nbr", *borrowed), train, ["store_nbr"])
        if validate:
            require_unique(places, ["store_nbr"], "merge_train: stores")
        out = attach(out, places, ["store_nbr"], small=fits_broadcast(places))

    # Written once: three joins read it, and its size is known before they are planned.
    days = as_date(holidays).select("date", "scope", "city", "state", *HOLIDAY_FLAGS)
    table = written(scope_flags(days), "holiday-flags")
    small = fits_broadcast(table)
    for scope in SCOPES:
        place = PLACES.get(scope)
        side = table.where(F.col("scope") == scope).select(
            "date", *([F.col("place").alias(place)] if place else []), F.struct(*HOLIDAY_FLAGS).alias(f"_{scope}")
        )
        out = attach(out, side, ["date", place] if place else ["date"], small=small)
    flags = [
        F.greatest(*[F.coalesce(F.col(f"_{scope}")[c], F.lit(0)) for scope in SCOPES]).alias(c) for c in HOLIDAY_FLAGS
    ]
    return out.select(*[c for c in train.columns if c not in HOLIDAY_FLAGS], *flags)
