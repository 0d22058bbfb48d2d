"""Raw feed lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_raw_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    glob: str = "*.txt",
    recursive: bool = True,
) -> DataFrame:
    """Lines of the files under ``path`` whose name matches ``glob``, as one column ``value``.

    ``path`` is a folder, file or pattern, a comma-joined list of them, or a sequence. A prefix is
    a pattern too: ``root/data*`` takes every folder and file that starts with ``data``. Files are
    split between tasks by size.
    """
    paths = path.split(",") if isinstance(path, str) else list(path)
    return (
        spark.read.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .text(paths)
        .select("value")
    )
