"""Boilerplate lines by their frequency within a site: the share of a site's pages that hold a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loomstar.llm.tables import column, free_names, sized
from loomstar.session import stored

#: A line on more than this share of a site's pages, and on two at least, is boilerplate: one page alone repeats nothing.
RATIO, PAGES = 0.05, 2


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _name(line: Column) -> Column:
    """Two 64-bit hashes of a line without its outer blanks."""
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("h1"), F.xxhash64(F.lit("line"), bare).alias("h2"))


def boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO, least: int = PAGES) -> DataFrame:
    """(host, lines): names of the boilerplate lines of each host that has any.

    A host cannot have more than (lines of its mean page) / ``ratio`` of them, so a row stays small.
    """
    own = pages.select(host.alias("host"), F.array_distinct(F.transform(F.filter(_lines(text), lambda x: F.trim(x) != ""), _name)).alias("lines"))
    total = stored(own.groupBy(F.col("host").alias("total_host")).agg(F.count(F.lit(1)).alias("pages")), "hosts")
    # a line is counted within each task before it is sent, so a line on every page is one row per task
    held = own.select("host", F.explode("lines").alias("line")).groupBy("host", "line.h1", "line.h2").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") >= least)
    many = held.join(sized(total), F.col("host").eqNullSafe(F.col("total_host"))).where(F.col("held") > ratio * F.col("pages"))
    return many.groupBy("host").agg(F.collect_list(F.struct("h1", "h2")).alias("lines"))


def drop_boilerplate(pages: DataFrame, host: Column, text: str = "text", ratio: float = RATIO, least: int = PAGES) -> DataFrame:
    """``pages`` with three more columns: _kept (the text without boilerplate lines), _lines and _dropped (counts of lines).

    A line is boilerplate if more than ``ratio`` of its host's pages hold it, and ``least`` pages at least; it is compared
    without outer blanks and counted once a page. Blank lines are kept and never counted; a null text is empty. Pages without
    a host (null) are one host. An empty table gives no rows; repeated rows are pages of their own. Where ``pages`` has a
    column of one of the three names, the new one gets underscores in front (``tables.free_names``).
    """
    bad = sized(stored(boilerplate(pages, host, column(text), ratio, least), "boilerplate"), 50_000)
    site, bad_site, bad_lines, left = free_names(pages, "_site", "_bad_site", "_bad_lines", "_left")
    out = free_names(pages, "_kept", "_lines", "_dropped")
    marked = pages.withColumn(site, host).join(bad.toDF(bad_site, bad_lines), column(site).eqNullSafe(column(bad_site)), "left")
    known = F.coalesce(bad_lines, F.array().cast("array<struct<h1:bigint,h2:bigint>>"))
    lines = _lines(column(text))
    kept = F.when(F.size(known) == 0, lines).otherwise(F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(known, _name(x))))
    done = marked.withColumn(left, kept)
    return done.select(*[column(c) for c in pages.columns], F.array_join(left, "\n").alias(out[0]), F.size(lines).alias(out[1]), (F.size(lines) - F.size(left)).alias(out[2]))
