"""The content report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions import text as T


def report_lines(items: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, line): one text block per item (id, title, date, link, source,
    score) whose page (url, content) was fetched; the others have none."""
    j = items.join(pages.select("url", "content"), F.col("link") == F.col("url"))
    columns = [F.col("id").cast("string"), *(F.col(c) for c in ("title", "date", "link", "source", "score", "content"))]
    return j.select("id", T.report_line(*columns).alias("line"))


def write_report(items: DataFrame, pages: DataFrame, path: str) -> None:
    """The report as a table of its blocks, by id."""
    report_lines(items, pages).sortWithinPartitions("id").write.mode("overwrite").parquet(path)
