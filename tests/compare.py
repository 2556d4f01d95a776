"""Run registered queries next to their SQL answers and compare columns, types and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
}


def oracle_connection(root: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(df, con, sql: str) -> list[str]:
    """Empty when the Spark frame equals the SQL answer."""
    described = con.execute("DESCRIBE " + sql).fetchall()
    expected_types = {r[0]: r[1] for r in described}
    actual_types = {
        f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        for f in df.schema.fields
    }
    out = []
    if set(expected_types) != set(actual_types):
        return [f"columns {sorted(actual_types)} instead of {sorted(expected_types)}"]
    for name, kind in expected_types.items():
        if kind != actual_types[name]:
            out.append(f"type of {name}: {actual_types[name]} instead of {kind}")
    want = _sorted(con.execute(sql).fetchall(), list(expected_types))
    have = _sorted([tuple(r) for r in df.collect()], df.columns)
    if len(want) != len(have):
        out.append(f"{len(have)} rows instead of {len(want)}")
    wrong = [(h, w) for h, w in zip(have, want) if h != w]
    if wrong:
        out.append(f"{len(wrong)} rows differ, e.g. {wrong[0][0]} instead of {wrong[0][1]}")
    return out


def main(root: str, only: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from millrace.session import local_session

    spark = local_session("compare")
    con = oracle_connection(root)
    sql = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if only and not any(name.startswith(p) for p in only):
            continue
        start = time.time()
        try:
            df = query(spark, root)
            if name in sql:
                problems = differences(df, con, sql[name])
                note = "same" if not problems else "; ".join(problems)
            else:
                problems, note = [], f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            problems, note = [1], f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:24s} {time.time() - start:6.2f}s {note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
