"""JOIN-1 to JOIN-4: item, store, price and promotion columns for the sales table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators.relational import SOURCE_ORDER, aligned, attach, attach_measured, fits_broadcast, keep_one
from shelfline.schemas import as_date, numeric, require_columns

# Promotion keys, from the most to the least specific.
PROMO_KEYS = [["date", "store_nbr", "item_nbr"], ["date", "store_nbr"], ["date"]]


def _dimension(table: DataFrame, key: str, columns: Sequence[str], order_by: Sequence[str] | None) -> DataFrame:
    """One row per key; the columns that give the order are read for the choice and then dropped."""
    order = list(order_by or [c for c in (SOURCE_ORDER,) if c in table.columns])
    wanted = table.select(key, *columns, *[c for c in order if c not in (key, *columns)])
    return keep_one(wanted, [key], keep="first", order_by=order or None).select(key, *columns)


def create_extend_train(
    train: DataFrame,
    items: DataFrame,
    stores: DataFrame,
    *,
    items_order: Sequence[str] | None = None,
    stores_order: Sequence[str] | None = None,
) -> DataFrame:
    """JOIN-1: family and class by item, city and state by store; the first row of a repeated key wins."""
    require_columns(train, ["item_nbr", "store_nbr"], "create_extend_train")
    for table, key, columns, order in (
        (items, "item_nbr", ["family", "class"], items_order),
        (stores, "store_nbr", ["city", "state"], stores_order),
    ):
        require_columns(table, [key, *columns], "create_extend_train")
        dim = aligned(_dimension(table, key, columns, order), train, [key])
        # Measured after the choice of one row per key: a long raw table may hold few keys.
        train = attach(train, dim, [key], small=fits_broadcast(dim)).select(*train.columns, *columns)
    return train


def _price_column(oil: DataFrame, oil_col: str | None) -> str:
    if oil_col is not None:
        require_columns(oil, [oil_col], "join_oil_promos: oil")
        return oil_col
    if "dcoilwtico" in oil.columns:
        return "dcoilwtico"
    for f in oil.schema.fields:
        if f.name != "date" and numeric(f.dataType):
            return f.name
    raise ValueError("join_oil_promos: the oil table has no numeric column; name one with oil_col")


def join_oil(
    train: DataFrame, oil: DataFrame | None, *, oil_col: str | None = None, order_by: Sequence[str] | None = None
) -> DataFrame:
    """JOIN-2: the daily price as ``oil_price``; of several rows per day the last wins. No table, no change."""
    if oil is None or oil.isEmpty():
        return train
    if "date" not in oil.columns:
        raise ValueError("join_oil_promos: the oil table has no 'date' column")
    price = _price_column(oil, oil_col)
    oil = as_date(oil)
    order = list(order_by or [c for c in (SOURCE_ORDER,) if c in oil.columns])
    wanted = oil.select("date", F.col(price).cast("double").alias("oil_price"), *[c for c in order if c != price])
    order = ["oil_price" if c == price else c for c in order]
    daily = keep_one(wanted, ["date"], keep="last", order_by=order or None).select("date", "oil_price")
    base = train.drop("oil_price")
    # One row per day: the calendar bounds it (all dates Spark can hold make 3.65 million rows of two numbers).
    return attach(base, daily, ["date"], small=True).select(*base.columns, "oil_price")


def join_promos(
    train: DataFrame,
    promos: DataFrame | None,
    *,
    overwrite_onpromotion: bool = True,
    order_by: Sequence[str] | None = None,
    small: bool = False,
) -> DataFrame:
    """JOIN-3 and JOIN-4: promotion columns on the most specific key both tables have; the last row of a key wins.

    A clashing ``onpromotion`` replaces that of the sales table unless told otherwise; other clashes are prefixed.
    Promotion tables on the full key can be as long as the sales table, so both sides are shuffled on it, unless ``small`` asks
    for a measurement. Tables on fewer keys are stored, measured and broadcast if they are small.
    """
    if promos is None or promos.isEmpty():
        return train
    keys = next((ks for ks in PROMO_KEYS if set(ks) <= set(promos.columns) and set(ks) <= set(train.columns)), None)
    if keys is None:
        raise ValueError("join_oil_promos: promos and train share no key; at least 'date' is needed")
    columns = [c for c in promos.columns if c not in keys and c != SOURCE_ORDER]
    if not columns:
        return train

    renamed = {}
    for c in columns:
        replaces = c == "onpromotion" and overwrite_onpromotion
        renamed[c] = f"promo_{c}" if c in train.columns and not replaces else c
    base = train.drop("onpromotion") if overwrite_onpromotion and "onpromotion" in columns else train

    order = list(order_by or [c for c in (SOURCE_ORDER,) if c in promos.columns])
    side = aligned(as_date(promos).select(*keys, *columns, *[c for c in order if c not in (*keys, *columns)]), train, keys)
    side = keep_one(side, keys, keep="last", order_by=order or None)
    side = side.select(*keys, *[F.col(c).alias(renamed[c]) for c in columns])
    if keys != PROMO_KEYS[0] or small:
        return attach_measured(base, side, keys).select(*base.columns, *renamed.values())
    return attach(base, side, keys, small=False).select(*base.columns, *renamed.values())


def join_oil_promos(
    train: DataFrame,
    oil: DataFrame | None,
    promos: DataFrame | None,
    *,
    oil_col: str | None = None,
    overwrite_onpromotion: bool = True,
    oil_order: Sequence[str] | None = None,
    promos_order: Sequence[str] | None = None,
) -> DataFrame:
    """JOIN-2 to JOIN-4 in one call."""
    train = as_date(train)
    train = join_oil(train, oil, oil_col=oil_col, order_by=oil_order)
    return join_promos(train, promos, overwrite_onpromotion=overwrite_onpromotion, order_by=promos_order)
