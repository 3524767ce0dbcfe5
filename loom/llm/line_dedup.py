"""Line dedup by site-relative frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loom.llm.common import materialize

RATIO, MIN_PAGES = 0.3, 4
#: Fixed patterns, which SQL uses too: what is no text, what ends a line, any other tag, the host of an address.
HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
BREAKS = r"(?i)</?(?:p|br|li|ul|ol|div|h[1-6]|tr|td|th|table|nav|article|section|header|footer|title|head|body|html|blockquote|pre)\b[^>]*>|[\r\n]+"
TAG = r"<[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def page_lines(html: Column) -> Column:
    """The text lines of a page in order: blocks and line ends separate them, blanks run together, empty ones are left out."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "\n"), BREAKS, "\n"), TAG, "")
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, r"[\x20\x09-\x0D]+", " ")))
    return F.filter(lines, lambda x: x != "")


def boilerplate_free(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", ratio: float = RATIO,
        min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per row of pages: id, host, n_lines, n_dropped, kept_text (the kept lines joined by line ends).

    A line is dropped when more than `ratio` of its host's pages contain it, on hosts of at least min_pages pages. The host is
    the address's, lower-cased; rows without one (null or odd url) keep all lines. Every row is a page, repeated ids included;
    a line that a page repeats counts once for the page. Null html has no lines. An empty table gives an empty result.

    Lines are counted by host and MD5, 16 bytes each, with partial sums; a host keeps at most (mean lines a page) / ratio
    keys, which are gathered per host and joined to its pages. Both sides of that join are written tables, so adaptive
    execution can split a host that holds a third of the pages. No line is sorted or regrouped to put pages together again.
    """
    host = F.lower(F.nullif(F.regexp_extract(url_col, HOST, 1), F.lit("")))
    lines = materialize(pages.select(F.col(id_col).alias("id"), host.alias("host"), page_lines(F.col(html_col)).alias("lines")))
    key = lambda x: F.unhex(F.md5(x))
    total = lines.where("host IS NOT NULL").groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    counted = lines.where("host IS NOT NULL").select("host", F.explode(F.array_distinct(F.transform("lines", key))).alias("key")).groupBy("host",
        "key").agg(F.count("*").alias("n"))
    frequent = materialize(counted.join(materialize(total),
        "host").where(F.col("n") > F.col("pages") * F.lit(ratio)).groupBy("host").agg(F.collect_list("key").alias("keys")))
    joined = lines.join(frequent, "host", "left")
    kept = F.when(F.col("keys").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains("keys", key(x))))
    return joined.withColumn("kept", kept).select(F.col("id").alias(id_col), "host", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("kept_text"))
