"""Reports as files: tables first, the summary last, so a reader that finds the summary finds all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .store import Folder

SUMMARY = "summary.json"


def write_report(root: str, tables: dict[str, DataFrame], summary: dict, fmt: str = "csv", single_file: bool = False) -> None:
    """Each table in a folder of its own (``csv`` with a header, ``json`` lines or ``parquet``).

    An earlier summary is removed first.  ``single_file`` is for small reports only: one task writes them.
    """
    if not tables:
        raise ValueError("a report has at least one table")
    spark = next(iter(tables.values())).sparkSession
    folder = Folder(spark, root)
    folder.delete_json(SUMMARY)
    for name, df in tables.items():
        out = (df.coalesce(1) if single_file else df).write.mode("overwrite")
        (out.option("header", True) if fmt == "csv" else out).format(fmt).save(f"{folder.root}/{name}")
    folder.write_json(SUMMARY, summary | {"tables": sorted(tables)})


def read_summary(spark, root: str) -> dict | None:
    return Folder(spark, root).read_json(SUMMARY)
