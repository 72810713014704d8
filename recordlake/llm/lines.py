"""Line dedup by site-relative frequency, in DataFrame functions only.

A line is boilerplate of its host when the share of the host's pages that contain it exceeds
``ratio``. The share is (pages of the host with the line) / (pages of the host); a line counts
once for each page. Lines are compared without the spaces around them. With ``copies_once`` the exact copies of
a page in a host are one page: else a page copied often enough would lose all its lines as boilerplate, in every copy.

How it scales:

* One aggregation on (host, line digest), which is pre-aggregated before the shuffle, so a hot
  host is spread over as many keys as it has lines. Copies are reduced before by an aggregation on (host,
  text digest), likewise pre-aggregated; it shuffles digests, no texts.
* The lines over the ratio are few for any host: the shares of all its lines add up to its mean
  number of lines a page, so at most ``mean / ratio`` lines can exceed the ratio. They are kept as
  one array for each host, written to the shared folder and read back, so that Catalyst knows
  the size in bytes: small tables are broadcast by its own threshold, larger ones are joined by a
  shuffle whose hot host AQE splits.
* The texts are filtered in place; no text is exploded and gathered again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.frames import settle

RATIO = 0.1
MIN_PAGES = 2


def _key(line):
    return F.md5(F.trim(line))


def boilerplate_lines(df: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
                      min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """Lines over the ratio: one row per host with ``lines``, the digests of its boilerplate.

    A null host is a host of its own. Rows with a null text count as pages without lines. Blank
    lines are never boilerplate. A line must also be on ``min_pages`` pages of the host: the only page of a
    host keeps its lines. With ``copies_once`` rows of a host with the same text, or with a
    null text, are one page.
    """
    keys = F.array_distinct(F.transform(F.split("t", "\n"), lambda x: F.when(F.trim(x) != "", _key(x))))
    pages = df.select(F.col(host).alias("h"), F.col(text).alias("t")).select("h", F.md5("t").alias("d"), keys.alias("keys"))
    if copies_once:
        pages = settle(pages.distinct(), "distinct_pages")  # equal digests have equal keys
    totals = pages.groupBy("h").agg(F.count(F.lit(1)).alias("pages"))
    counts = (pages.select("h", F.explode("keys").alias("line")).where(F.col("line").isNotNull())
              .groupBy("h", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages))
    over = counts.join(totals.withColumnRenamed("h", "th"), F.col("h").eqNullSafe(F.col("th")))
    return (over.where(F.col("n") > F.lit(float(ratio)) * F.col("pages"))
            .groupBy("h").agg(F.sort_array(F.collect_set("line")).alias("lines")))


def drop_boilerplate(df: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """The rows of ``df`` with boilerplate lines taken out of ``text``, plus n_lines and n_removed.

    Every input row and column is kept. An input column called n_lines or n_removed is replaced.
    The other lines stay as they were, joined by a line feed. A null text stays null (0 lines); an
    empty text is one blank line, which is kept. An empty table gives an empty table. Repeated
    rows are pages of their own, unless ``copies_once`` is set; all of them are returned in any case.
    """
    found = settle(boilerplate_lines(df, text, host, ratio, min_pages, copies_once), "boilerplate")
    found = found.select(F.col("h").alias("__h"), F.col("lines").alias("__lines"))
    out = df.drop("n_lines", "n_removed")
    cols = [F.col(f"`{c}`") for c in out.columns]
    joined = out.join(found, F.col(f"`{host}`").eqNullSafe(F.col("__h")), "left")
    parts = F.split(F.col(f"`{text}`"), "\n")
    kept = F.filter(parts, lambda x: ~F.array_contains(F.col("__lines"), _key(x)))
    cut = joined.withColumn("__kept", F.when(F.col("__lines").isNull(), parts).otherwise(kept))
    n = F.coalesce(F.size(parts).cast("long"), F.lit(0).cast("long"))
    n = F.when(F.col(f"`{text}`").isNull(), F.lit(0).cast("long")).otherwise(n)
    m = F.when(F.col(f"`{text}`").isNull(), F.lit(0).cast("long")).otherwise(F.size("__kept").cast("long"))
    return cut.select(*[F.array_join("__kept", "\n").alias(text) if c == text else x
                        for c, x in zip(out.columns, cols)],
                      n.alias("n_lines"), (n - m).alias("n_removed"))
