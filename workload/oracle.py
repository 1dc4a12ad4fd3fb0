"""Compare a registered query with its SQL, run by DuckDB on the same Parquet tables."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or isinstance(v, (str, bool)):
        return v
    if isinstance(v, float):
        return round(v, 9)
    return v.item() if hasattr(v, "item") else v


def compare(spark_df, oracle) -> str:
    """Empty if both agree, else what differs."""
    kinds = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema}
    want = dict(zip(oracle.columns, map(str, oracle.types)))
    if set(kinds) != set(want):
        return f"columns {sorted(set(kinds) ^ set(want))}"
    fault = ", ".join(f"{c}: {kinds[c]} / {want[c]}" for c in sorted(want) if kinds[c] != want[c])
    names = sorted(want)
    ours = [tuple(_plain(r[c]) for c in names) for r in spark_df.select(*[f"`{n}`" for n in names]).collect()]
    order = [oracle.columns.index(c) for c in names]
    theirs = [tuple(_plain(r[i]) for i in order) for r in oracle.fetchall()]
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}; {fault}"
    if not ours:
        return f"no rows; {fault}"
    a, b = sorted(ours, key=repr), sorted(theirs, key=repr)
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    if differing:
        return f"{len(differing)} of {len(a)} rows differ, first {differing[0]}; {fault}"
    return f"types {fault}" if fault else ""
