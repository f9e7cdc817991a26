"""Run the registered queries against their SQL: ``python -m checks.compare [sf_dir] [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from incident_mart.session import build_session

from . import registry


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted: the order-free form of a result."""
    out = pd.DataFrame({c: df[c].map(_text) for c in sorted(df.columns)})
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def _text(value: object) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "NULL"
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, float) and value == int(value):
        return str(int(value))
    return str(value)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """Why two results differ, or None."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    left, right = normal(got), normal(want)
    unequal = (left != right).any(axis=1)
    if unequal.any():
        return f"{unequal.sum()} rows differ:\n{left[unequal].head(3)}\n{right[unequal].head(3)}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(
        "compare", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, run in registry.queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            got = run(spark, sf_dir).toPandas()
            trouble = differences(got, con.execute(registry.oracle_sql()[name]).df())
        except Exception as error:  # noqa: BLE001
            got, trouble = [], str(error)[:1500]
        failed += trouble is not None
        took = time.perf_counter() - start
        print(f"{'ok  ' if trouble is None else 'FAIL'} {name:20} {len(got):7} rows {took:6.2f}s")
        if trouble:
            print(trouble)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
