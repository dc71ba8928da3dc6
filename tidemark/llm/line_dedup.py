"""Site-relative line dedup: drop the lines a site repeats on its pages.

Lines are counted per host as pages holding them, so a host with a third of all
pages is summed before it is shuffled. What joins back is one row per host with
its boilerplate lines: a page has on average L distinct lines, so at most
L / max_ratio lines of a host can be on more than max_ratio of its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import saved

# Elements whose content is no text, and elements that end a line.
HIDDEN = "|".join(rf"<{tag}(?:[ \t\r\n][^>]*)?>.*?</{tag}[ \t\r\n]*>" for tag in ("script", "style", "noscript", "template")) + "|<!--.*?-->"
BLOCKS = (
    "p", "div", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "br", "hr", "tr", "td", "th", "table", "article",
    "section", "nav", "header", "footer", "aside", "main", "title", "head", "body", "html", "blockquote", "pre", "form",
    "figure", "figcaption", "dl", "dt", "dd", "option", "textarea",
)
HIDDEN_TAGS = f"(?is){HIDDEN}"
BLOCK_TAGS = rf"(?i)</?(?:{'|'.join(BLOCKS)})(?:[ \t\r\n/][^>]*)?>"
OTHER_TAGS = "<[a-zA-Z/!?][^>]*>"
BLANK_RUN = r"[ \t\r\x0B\f]+"
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def page_lines(html: Column) -> Column:
    """The visible lines of a page: trimmed, blanks joined, empty ones left out."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN_TAGS, " ")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK_TAGS, "\n"), OTHER_TAGS, "")
    lines = F.transform(F.split(F.regexp_replace(text, BLANK_RUN, " "), "\n"), lambda line: F.trim(line))
    return F.filter(lines, lambda line: line != "")


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def _mark(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit(1)).alias("b"))


def drop_boilerplate(
    pages: DataFrame, max_ratio: float = 0.1, least_pages: int = 2,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """page_id, host, n_lines, n_dropped, text: one row per input row.

    A line goes when it stands on at least ``least_pages`` pages of the host and
    on more than ``max_ratio`` of them (two pages are the fewest that repeat a line); a page counts once for a line it repeats,
    and loses every repeat. Rows count as pages even if alike. Pages without a
    readable host keep all lines (host ''); null or empty HTML has no lines and
    an empty text.
    """
    # Written once: finding the lines of a page costs more than all that follows.
    rows = saved(
        pages.select(
            pages[id_col].alias("page_id"), host(pages[url_col].cast("string")).alias("host"), page_lines(pages[html_col].cast("string")).alias("lines")
        ),
        "page-lines",
    )
    sited = rows.where("host <> ''")
    totals = sited.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = (
        sited.select("host", F.explode(F.array_distinct(F.transform("lines", _mark))).alias("line"))
        .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages)
    )
    boilerplate = (
        counts.join(totals, "host").where(F.col("n") / F.col("pages") > max_ratio)
        .groupBy("host").agg(F.collect_list("line").alias("repeated"))
    )
    kept = F.when(F.col("repeated").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda line: ~F.array_contains("repeated", _mark(line)))
    )
    return rows.join(boilerplate, "host", "left").withColumn("kept", kept).select(
        "page_id", "host", F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("bigint").alias("n_dropped"), F.array_join("kept", "\n").alias("text"),
    )


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


ORACLE = f"""
WITH p AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '{_sql(HOST)}', 1)) AS host,
         list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
           '{_sql(HIDDEN_TAGS)}', ' ', 'g'), '{_sql(BLOCK_TAGS)}', chr(10), 'g'), '{_sql(OTHER_TAGS)}', '', 'g'),
           '{_sql(BLANK_RUN)}', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines
  FROM pages),
h AS (SELECT host, count(*) AS pages FROM p WHERE host <> '' GROUP BY host),
l AS (SELECT host, unnest(list_distinct(lines)) AS line FROM p WHERE host <> ''),
c AS (SELECT host, line, count(*) AS n FROM l GROUP BY host, line),
b AS (SELECT host, list(line) AS repeated FROM c JOIN h USING (host) WHERE n >= 2 AND n / pages > 0.1 GROUP BY host),
k AS (SELECT p.page_id, p.host, p.lines, CASE WHEN repeated IS NULL THEN p.lines
             ELSE list_filter(p.lines, lambda x: NOT list_contains(repeated, x)) END AS kept
      FROM p LEFT JOIN b ON p.host = b.host)
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(kept) AS BIGINT) AS n_dropped,
       CASE WHEN len(kept) = 0 THEN '' ELSE array_to_string(kept, chr(10)) END AS text
FROM k
"""
