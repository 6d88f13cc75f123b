"""Run registered queries and their SQL on the same tables and compare the rows."""

from __future__ import annotations

import os
import sys
import time
from datetime import datetime

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _kind(dtype: str) -> str:
    dtype = dtype.lower()
    for kind, names in {
        "int": ("int", "bigint", "integer", "smallint", "hugeint"),
        "double": ("double", "float"),
        "text": ("string", "varchar"),
        "bool": ("boolean",),
    }.items():
        if dtype in names:
            return kind
    return dtype


def _text(value: object) -> str:
    """A value as text; of times, whole seconds."""
    return str(value)[:19].removesuffix(" 00:00:00") if isinstance(value, datetime) else str(value)


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame(index=df.index)
    for c in sorted(df.columns):
        s = df[c].astype(object)
        s = s.where(s.notna(), None)
        out[c] = s.map(lambda x: "~" if x is None else (f"{x:.6f}" if isinstance(x, float) else _text(x)))
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def as_frame(df) -> pd.DataFrame:
    """A Spark result with missing integers kept as missing, not as floating numbers."""
    return df.toArrow().to_pandas(types_mapper=_nullable, date_as_object=True)


def _nullable(arrow_type):
    import pyarrow as pa

    if pa.types.is_integer(arrow_type):
        return pd.Int64Dtype()
    if pa.types.is_boolean(arrow_type):
        return pd.BooleanDtype()
    return None


def mismatch(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when both give the same rows, else what differs."""
    result = query(spark, sf_dir)
    relation = con.sql(sql)
    kinds = {name: _kind(str(kind)) for name, kind in zip(relation.columns, relation.types, strict=True)}
    got_kinds = {f.name: _kind(f.dataType.simpleString()) for f in result.schema.fields}
    if sorted(kinds) != sorted(got_kinds):
        return f"columns: spark {sorted(got_kinds)} sql {sorted(kinds)}"
    wrong = {c: (got_kinds[c], kinds[c]) for c in kinds if kinds[c] != got_kinds[c] and "decimal" not in kinds[c]}
    if wrong:
        return f"types (spark, sql): {wrong}"
    want = canonical(relation.to_arrow_table().to_pandas(types_mapper=_nullable, date_as_object=True))
    got = canonical(as_frame(result))
    if len(want) != len(got):
        return f"rows: spark {len(got)} sql {len(want)}"
    for c in want.columns:
        bad = want[c] != got[c]
        if bad.any():
            i = bad.idxmax()
            return f"{int(bad.sum())} rows differ, e.g. column {c}: spark {got.loc[i].to_dict()} sql {want.loc[i].to_dict()}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from queries.registry import ORACLES, QUERIES
    from shelfline.session import build_session

    directory = sys.argv[1]
    wanted = sys.argv[2:] or list(QUERIES)
    session = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    connection = duck(directory)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            if name in ORACLES:
                found = mismatch(session, connection, QUERIES[name], ORACLES[name], directory)
            else:
                found = None if QUERIES[name](session, directory).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print("failed:", failed)
