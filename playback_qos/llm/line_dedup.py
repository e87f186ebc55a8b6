"""Boilerplate lines by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playback_qos.llm.common import written

#: A line in more than this share of a host's pages is boilerplate ...
RATIO = 0.1
#: ... if that many pages of the host hold it.
MIN_PAGES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^ \t\n\x0B\f\r]")


def boilerplate_lines(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    distinct_pages: bool = False,
) -> DataFrame:
    """(host, line_hash, n_pages, host_pages) of lines in more than ``ratio`` of a host's pages.

    Each page counts a line once, before anything moves, and each task sums its
    pages first, so a host or line in a third of all rows costs a row a task.
    Lines are told apart by 64-bit hashes. At most (distinct lines of a mean
    page) / ratio lines of a host can pass. With ``distinct_pages``, rows of a
    host with the same text (by its SHA-256) are one page: each task leaves one
    of them before they move, and the pages' line hashes are written once.
    """
    hashes = F.array_distinct(F.transform(F.filter(_lines(F.col(text)), _has_word), lambda x: F.xxhash64(x)))
    rows = docs.select(F.col(host).alias("host"), F.col(text).alias("text"), hashes.alias("line_hashes"))
    if distinct_pages:
        rows = written(rows.select("host", F.sha2("text", 256).alias("page"), "line_hashes").distinct())
    pages = rows.groupBy("host").agg(F.count("*").alias("host_pages"))
    held = (
        rows.select("host", F.explode("line_hashes").alias("line_hash"))
        .groupBy("host", "line_hash")
        .agg(F.count("*").alias("n_pages"))
        .filter(F.col("n_pages") >= min_pages)
    )
    return (
        held.join(pages.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")))
        .filter(F.col("n_pages") > F.lit(ratio) * F.col("host_pages"))
        .select("host", "line_hash", "n_pages", "host_pages")
    )


def drop_boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    distinct_pages: bool = False,
) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``; adds n_lines and n_dropped.

    All rows stay, also those left without a line (text ''); a null text stays
    null with 0 lines. Lines without a word are never boilerplate. A null host
    is a host. Repeated rows are pages each, unless ``distinct_pages``. Columns of ``docs`` that are named
    n_lines or n_dropped are replaced; all others pass through.

    The lines of each host are one small row, written first, so the planner
    knows their size: it broadcasts them if they are small, else joins by host
    and splits hot hosts (adaptive skew join).
    """
    lists = written(
        boilerplate_lines(docs, host, text, ratio, min_pages, distinct_pages)
        .groupBy("host")
        .agg(F.sort_array(F.collect_set("line_hash")).alias("__line_drop"))
        .withColumnRenamed("host", "__line_host")
    )
    lines = _lines(F.col(text))
    kept = F.filter(lines, lambda x: ~(_has_word(x) & F.array_contains(F.col("__line_drop"), F.xxhash64(x))))
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long")
    hit = F.col("__line_drop").isNotNull() & F.col(text).isNotNull()
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return (
        docs.join(lists, F.col(host).eqNullSafe(F.col("__line_host")), "left")
        .withColumn("__line_kept", F.when(hit, kept))
        .select(
            *[F.when(hit, F.array_join("__line_kept", "\n")).otherwise(F.col(text)).alias(text) if c == text else F.col(c) for c in rest],
            n_lines.alias("n_lines"),
            F.when(hit, n_lines - F.size("__line_kept")).otherwise(F.lit(0)).cast("long").alias("n_dropped"),
        )
    )
