"""Line dedup by site-relative frequency.

A line is boilerplate of a host if it stands on more than a given share of the host's
pages. A page counts once by line, however often it repeats it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queryset.llm.scratch import written
from queryset.llm.urls import host_of

#: Elements whose content is no text, and tags that end a line.
HIDDEN = r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->"
BREAKS = r"(?i)</?(p|div|br|li|ul|ol|h1|h2|h3|h4|h5|h6|title|table|tr|td|th|article|section|nav|header|footer|body|head|html|blockquote|pre)([ /][^>]*)?>"


def lines_of(html: Column) -> Column:
    """Lines of text of a page: trimmed, without tags, none empty."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "")
    text = F.regexp_replace(F.regexp_replace(text, BREAKS, "\n"), "<[^>]*>", "")
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, r"^[ \t\r\f\x0B]+|[ \t\r\f\x0B]+$", "")), lambda x: x != "")


def boilerplate(pages: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """``host, boilerplate``: hashes of the lines on more than ``ratio`` of a host's pages, for hosts of ``min_pages`` pages at least.

    A host has at most (lines of a mean page) / ratio such lines, so the arrays stay
    small however many pages it has. Counting is combined before the shuffle by host and
    line, so a host with a third of all pages costs no more than another.
    """
    hashes = F.array_distinct(F.transform("lines", lambda x: F.xxhash64(x)))
    totals = pages.groupBy("host").agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= min_pages)
    counts = pages.select("host", F.explode(hashes).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    often = counts.join(totals, "host").where(F.col("n") > F.col("n_pages") * F.lit(ratio))
    return often.groupBy("host").agg(F.collect_list("line").alias("boilerplate"))


def _beside(rows: DataFrame, found: DataFrame, max_broadcast_lines: int, salts: int) -> DataFrame:
    """Rows with the boilerplate of their host. A counted, small table is broadcast; a larger one meets rows that are salted, so that no host is one task."""
    size = found.agg(F.sum(F.size("boilerplate")).alias("n")).first()["n"] or 0
    if size <= max_broadcast_lines:
        return rows.join(F.broadcast(found), "host", "left")
    spread = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", F.size("lines")), F.lit(salts)).cast("int"))
    return salted.join(spread, ["host", "salt"], "left").drop("salt")


def without_boilerplate(pages: DataFrame, ratio: float = 0.2, min_pages: int = 5, max_broadcast_lines: int = 1_000_000, salts: int = 64, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, host, n_lines, n_dropped, kept_text`` of every page.

    Null urls and urls without :// share the empty host; null and empty pages have no
    lines; repeated rows each keep their row and count as pages; other columns are
    ignored; an empty table gives no rows.
    """
    # Counting and dropping both need the lines; taking them from the HTML costs most of the job, so it is done once.
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url_col).alias("host"), lines_of(F.col(html_col)).alias("lines"))
    rows = written(rows, "lines")
    found = _beside(rows, written(boilerplate(rows, ratio, min_pages), "boilerplate"), max_broadcast_lines, salts)
    kept = F.when(F.col("boilerplate").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains("boilerplate", F.xxhash64(x))))
    found = found.withColumn("kept", kept)
    return found.select("page_id", "host", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("kept_text"))
