"""Saving a report in the format the reader prefers."""

from __future__ import annotations

from pyspark.sql import DataFrame

_OPTIONS = {
    "csv": {"header": "true", "escape": '"'},
    "json": {"ignoreNullFields": "false"},
    "parquet": {},
}


def write_report(
    report: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists"
) -> None:
    """Write ``report`` as ``csv`` (with header), ``json`` or ``parquet``.

    A sorted report stays sorted over the numbered part files.
    """
    if fmt not in _OPTIONS:
        raise ValueError(f"format must be one of {sorted(_OPTIONS)}, not {fmt!r}")
    report.write.mode(mode).format(fmt).options(**_OPTIONS[fmt]).save(path)
