"""Run registered queries in Spark and DuckDB and compare names, row counts and values.

    python -m tests.compare FOLDER [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import all_entries as entries  # noqa: E402
from voxscope.catalog.base import NAMES, Tables  # noqa: E402


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if hasattr(value, "is_integer") and float(value) == value and abs(value) < 2**53:
        return int(value)
    return value if isinstance(value, (int, float, str)) else str(value)


def _table(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def _close(a: tuple, b: tuple) -> bool:
    return all(x == y or (isinstance(x, (int, float)) and isinstance(y, (int, float))
                          and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)) for x, y in zip(a, b, strict=True))


def difference(spark, folder: str, name: str, con=None, forbidden: tuple[str, ...] = ()) -> str | None:
    """None when both sides agree, else what differs; without a statement only run Spark.

    ``forbidden`` are operators that the plan that ran must not have.
    """
    entry = entries()[name]
    df = entry.run(Tables(spark, folder))
    names, rows = _table(df.columns, df.collect())
    if not rows:
        return "no rows"
    plan = df._jdf.queryExecution().executedPlan().toString()
    if found := [word for word in forbidden if word in plan]:
        return f"plan has {', '.join(found)}"
    if entry.sql is None:
        return None
    con = con or duck(folder)
    result = con.execute(entry.sql)
    names2, rows2 = _table([d[0] for d in result.description], result.fetchall())
    if names != names2:
        return f"columns {names} and {names2}"
    if rows == rows2:
        return None
    left, right = rows - rows2, rows2 - rows
    text = f"{sum(rows.values())} and {sum(rows2.values())} rows, {sum(left.values())} differ"
    a = sorted(left, key=str)[:2]
    b = sorted(right, key=str)[:2]
    if len(left) == len(right) and all(_close(x, y) for x, y in
                                       zip(sorted(left, key=str), sorted(right, key=str), strict=True)):
        text += " (last digits only)"
    return f"{text}\n   {names}\n   spark {str(a)[:700]}\n   duck  {str(b)[:700]}"


def main() -> None:
    from voxscope.session import build_session

    folder, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, **{"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel(os.environ.get("LOG", "OFF"))
    con, failed = duck(folder), []
    for name in entries():
        if chosen and not any(name == c or (c.endswith("*") and name.startswith(c[:-1])) for c in chosen):
            continue
        start = time.time()
        try:
            problem = difference(spark, folder, name, con)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        mark = "ok" if problem is None else "FAIL"
        print(f"{mark:5}{name:32}{time.time() - start:7.2f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(len(failed), "failed:", " ".join(failed))


if __name__ == "__main__":
    main()
