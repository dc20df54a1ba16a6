"""Line dedup by site-relative frequency.

Pages are grouped by host; a line's ratio is the share of the host's pages that contain it.
Lines whose ratio is over ``max_ratio`` by more than ``errors`` standard errors are boilerplate of
that host and are dropped from its pages. Exact copies of a page count as one page of
their host, so that a page copied many times is not taken for boilerplate.

``max_ratio`` lies where the measured ratios part: licence lines and the like stand on 0.2 % of a site's
pages or more in large sites, lines that only near copies share nearly all on less. The error term makes that hold at every size:
in a host of few pages a few pages are a high ratio by chance, so with the defaults a line has to be on more than 4.4 % of 50
pages, 0.77 % of 500, 0.33 % of 5,000 and 0.2 % of a very large host; one or two pages are never enough.

Defined results: a null text stays null; a text whose lines all go becomes empty; empty
lines are kept and never counted; rows with a null host are one host; repeated rows stay
repeated, and ties (lines exactly at the threshold) stay; very long texts are taken whole; all columns but the text are unchanged, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import staged, unused

MAX_RATIO = 0.002
ERRORS = 2.0


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, errors: float = ERRORS) -> DataFrame:
    """(host, bad): each host's boilerplate lines as 64-bit hashes.

    A host's lines over the ratio number at most (mean lines of a page) / ``max_ratio``.
    Only hashes are shuffled; a hot host's lines spread over tasks by line, and its page
    total is a partial sum.
    """
    hashes = F.transform(F.filter(_lines(F.col("t")), lambda x: x != ""), lambda x: F.xxhash64(x))
    # one row for each distinct page of a host; repeated lines of a page count once
    once = (pages.select(F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").alias("t")).filter(F.col("t").isNotNull())
            .select("host", F.xxhash64("t").alias("page"), F.array_distinct(hashes).alias("lines"))
            .groupBy("host", "page").agg(F.first("lines").alias("lines")))
    # the page itself is one more entry of its line list, so one aggregation gives counts and totals
    counted = (once.select("host", F.explode(F.concat(F.array(F.lit(None).cast("long")), "lines")).alias("line"))
               .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")))
    totals = counted.filter(F.col("line").isNull()).select(F.col("host").alias("h"), F.col("n").alias("pages"))
    # a line on errors pages or less is over no host's threshold
    often = counted.filter(F.col("line").isNotNull() & (F.col("n") > errors))
    usual = max_ratio * F.col("pages")  # pages of a line that is just no boilerplate
    return (often.join(totals, F.col("host").eqNullSafe(F.col("h")))
            .filter(F.col("n") > usual + errors * F.sqrt(usual + 1))
            .groupBy("host").agg(F.collect_list("line").alias("bad")))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, errors: float = ERRORS) -> DataFrame:
    """``pages`` without each host's boilerplate lines; every row and column stays.

    The boilerplate table is written first, so that its true size decides how it is joined: the pages
    are shuffled only if it is too large to broadcast.
    """
    site, lines = unused(pages.columns, "site"), unused(pages.columns, "boilerplate")
    bad = staged(boilerplate(pages, host, text, max_ratio, errors), "line-boilerplate").select(F.col("host").alias(site), F.col("bad").alias(lines))
    own = F.col(f"`{text}`")
    kept = F.array_join(F.filter(_lines(own), lambda x: (x == "") | ~F.array_contains(F.col(lines), F.xxhash64(x))), "\n")
    joined = pages.join(bad, F.col(f"`{host}`").eqNullSafe(F.col(site)), "left")
    return joined.select(*[F.when(F.col(lines).isNull(), own).otherwise(kept).alias(c) if c == text else F.col(f"`{c}`") for c in pages.columns])
