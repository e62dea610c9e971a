"""Line dedup by site-relative frequency.

Pages are grouped by host; a line's ratio is the number of the host's pages that contain it divided by the host's number of pages.
Lines with a ratio over ``max_ratio``, on at least ``min_pages`` pages of the host, are boilerplate of that host and are
dropped from all its pages. Lines are the text's parts between line feeds and are compared after trimming blanks (spaces, tabs,
carriage returns); blank lines stay.

Counting shuffles one fixed-size row per distinct line of a page (two 64-bit hashes, summed before the shuffle, so a line that is on every
page of a host with a third of all pages costs one row a task). Boilerplate lines are at most ``lines per page / max_ratio`` a host;
each is replicated ``SALTS`` times, so that pages with the hottest line spread over that many tasks. Texts are moved once, to meet what is to be dropped.

Defined cases: a null text has no lines and stays null; an empty text has one blank line. A null host is a host. Repeated rows are pages
of their own, with the same result. Other columns are kept as they are; ``n_lines`` and ``n_removed`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 32
BLANK = " \t\r"


def _key(line: Column) -> Column:
    s = F.btrim(line, F.lit(BLANK))
    return F.when(s != "", F.struct(F.xxhash64(s).alias("a"), F.xxhash64(F.lit(1), s).alias("b")))


def boilerplate(pages: DataFrame, *, max_ratio: float, min_pages: int) -> DataFrame:
    """``host, a, b`` of lines to drop, from pages (host, keys: the page's distinct line keys)."""
    counts = pages.select("host", F.explode("keys").alias("k")).groupBy("host", "k.a", "k.b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    total = pages.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    return counts.join(total, "host").where(F.col("n") > F.col("total") * F.lit(max_ratio)).select("host", "a", "b")


def line_dedup(docs: DataFrame, *, text_col: str = "text", host_col: str = "source", max_ratio: float = 0.05, min_pages: int = 5) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text_col``, and the longs ``n_lines`` and ``n_removed``."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    lines = F.split(F.col("text"), "\n")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names if c != text_col]).alias("row"), F.col(f"`{text_col}`").alias("text"),
        F.coalesce(F.concat(F.lit("0"), F.col(f"`{host_col}`").cast("string")), F.lit("1")).alias("host"),
    )
    pages = rows.select("host", F.xxhash64("text").alias("t"), F.xxhash64(F.lit(1), "text").alias("u"), F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt"), F.array_distinct(F.filter(F.transform(lines, _key), lambda k: k.isNotNull())).alias("keys"))
    drop = boilerplate(pages, max_ratio=max_ratio, min_pages=min_pages).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    on = pages.select("host", "t", "u", "salt", F.explode("keys").alias("k")).select("host", "t", "u", "salt", "k.a", "k.b")
    # what goes depends on host and text alone, so equal pages share a row
    found = on.join(drop, ["host", "a", "b", "salt"]).groupBy("host", "t", "u").agg(F.collect_set(F.struct("a", "b")).alias("drop"))
    out = rows.withColumns({"t": F.xxhash64("text"), "u": F.xxhash64(F.lit(1), "text")}).join(found, ["host", "t", "u"], "left")
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col("drop"), _key(x)), F.lit(False)))
    out = out.withColumn("kept", F.when(F.col("drop").isNull(), lines).otherwise(kept))
    n = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    n = F.when(F.col("text").isNull(), F.lit(0)).otherwise(n).cast("long")
    return out.select(
        *[(F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n")) if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in names],
        n.alias("n_lines"), (n - F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("kept"))).cast("long").alias("n_removed"),
    )
