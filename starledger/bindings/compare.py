"""Order-insensitive comparison of a Spark result with the oracle's."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame

# Column types the two engines name differently.
_SAME = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def oracle_connection(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _key(row: tuple) -> tuple:
    return tuple((value is not None, str(value)) for value in row)


def compare(df: DataFrame, connection, sql: str | None) -> str | None:
    """None when both sides agree, else what differs. Without SQL only the run is checked."""
    names = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    if sql is None:
        return None
    cursor = connection.execute(sql)
    other = [d[0] for d in cursor.description]
    if sorted(other) != names:
        return f"columns {names} against {sorted(other)}"
    place = [other.index(n) for n in names]
    types = {d[0]: str(d[1]) for d in cursor.description}
    mine = {n: t.upper() if t.startswith("decimal") else _SAME.get(t, t) for n, t in df.dtypes}
    wrong = {
        n: (mine[n], types[n])
        for n in names
        if mine[n] not in (types[n], types[n].replace(" ", ""))
    }
    if wrong:
        return f"types {wrong}"
    expected = [tuple(r[i] for i in place) for r in cursor.fetchall()]
    if len(rows) != len(expected):
        return f"{len(rows)} rows against {len(expected)}"
    for a, b in zip(sorted(rows, key=_key), sorted(expected, key=_key)):
        if a != b:
            return f"{names}: {a} against {b}"
    return None
