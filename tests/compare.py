"""Run registered queries and their SQL side by side and compare the rows."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemart import oracle, registry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type -> DuckDB type names that may stand for it.
TYPES = {
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
    "boolean": {"BOOLEAN"},
}


def database(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, Decimal):
        return value.normalize()
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, root: str, name: str) -> list[str]:
    """What differs between the query and its SQL; empty when they agree."""
    df = registry.registered()[name](spark, root)
    got = [tuple(r) for r in df.collect()]
    result = con.execute(oracle.statements()[name])
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    found = []
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    for column, kind in df.dtypes:
        expected = TYPES.get(kind, {kind.upper().replace(" ", "")})
        if kinds[column].replace(" ", "") not in expected:
            found.append(f"type of {column}: {kind} != {kinds[column]}")
    if len(got) != len(want):
        found.append(f"{len(got)} rows != {len(want)}")
    a, b = _rows(got, df.columns), _rows(want, columns)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        found.append(f"{len(bad)} rows differ, first {bad[0]}")
    if not got:
        found.append("no rows")
    return found


def main(argv: list[str]) -> int:
    from tidemart.session import build_session

    root = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(registry.registered())
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = database(root)
    failed = 0
    for name in names:
        begin = time.perf_counter()
        try:
            found = differences(spark, con, root, name)
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{time.perf_counter() - begin:7.2f}s  {name}: {'; '.join(found) or 'ok'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
