from __future__ import annotations

import math
from datetime import date, timedelta

DAY0 = date(2017, 1, 1)


def day(i: int) -> date:
    return DAY0 + timedelta(days=i)


def daily(spark, values, promos=None, store=1, item=1, start=0):
    rows = [
        (day(start + i), store, item, None if v is None else float(v), None if promos is None else promos[i])
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, "date date, store_nbr int, item_nbr int, unit_sales double, onpromotion boolean"
    )


def column(df, name, order=("date",)):
    return [r[name] for r in df.orderBy(*order).select(name, *[o for o in order if o != name]).collect()]


def close(got, want, tolerance=1e-9):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        if w is None or g is None:
            assert g is None and w is None, (got, want)
        else:
            assert math.isclose(g, w, rel_tol=tolerance, abs_tol=tolerance), (got, want)
