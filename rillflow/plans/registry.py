"""Names, builders and comparison SQL of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a builder under its name, with SQL that gives the same rows."""

    def add(f):
        key = name or f.__name__
        _QUERIES[key] = f
        if sql:
            _SQL[key] = sql
        return f

    return add


def values(rows: list[tuple], names: str) -> str:
    """A SQL table of literal rows."""

    def lit(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).upper()
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, (list, tuple)):
            return "[" + ", ".join(map(lit, v)) + "]"
        return f"{v!r}::DOUBLE" if isinstance(v, float) else repr(v)

    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS _v({names}))"


def _load() -> None:
    from . import catalogs, episodes, fidelity_studies, profiled_recordings, recordings, streams, training_logs  # noqa: F401


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    _load()
    return _QUERIES["align_rows"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
