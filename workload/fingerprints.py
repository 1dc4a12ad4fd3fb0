"""SQL of ``quality.fingerprint`` for the views of the archive."""

from __future__ import annotations

from pyspark.sql import types as T

from siltframe.schema import SCHEMAS

# The views call the counts so, as the word is a function in SQL.
_RENAMED = {("pollen_count", "count"): "cnt"}


def fingerprint_sql(name: str, source: str, columns: dict[str, str], places: int = 3) -> str:
    """One row per column of ``source``; ``columns`` maps header to (quoted) SQL name, doubles marked by a ``#``."""
    def text(sql: str) -> str:
        if sql.startswith("#"):
            return f"CAST(CAST(floor({sql[1:]} * {10**places} + 0.5) AS BIGINT) AS VARCHAR)"
        return f"CAST({sql} AS VARCHAR)"

    texts = {c: text(sql) for c, sql in columns.items()}
    texts["*"] = " || '|' || ".join(f"coalesce({t}, '~')" for t in texts.values())
    cells = ", ".join(
        f"{{'column_name': '{c}', 'n': count(*), 'filled': count({t}), 'total': CAST(coalesce(sum(CAST('0x' || substr(md5({t}), 1, 8) AS BIGINT)), 0) AS BIGINT)}}"
        for c, t in texts.items()
    )
    return f"SELECT '{name}' AS table_name, c.* FROM (SELECT unnest(cells) AS c FROM (SELECT [{cells}] AS cells FROM {source}))"


def table_sql(name: str, source: str | None = None, shown: str | None = None, extra: dict[str, str] | None = None) -> str:
    """The fingerprint of one table of the archive, or of a selection from it."""
    columns = {
        f.name: ("#" if isinstance(f.dataType, T.DoubleType) else "") + _RENAMED.get((name, f.name), f.name) for f in SCHEMAS[name]
    }
    return fingerprint_sql(shown or name, source or name, columns | (extra or {}))
