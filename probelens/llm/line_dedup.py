r"""Line deduplication by site-relative frequency.

A line is boilerplate on a host when it stands on more than ``ratio`` of the
host's pages, and on ``min_seen`` different ones at least: a guard against chance
(and against a few near copies of one page) that holds for hosts of every size. Pages are the host's distinct texts, so exact copies of one page
count once and do not turn its content into boilerplate; lines are compared
after trimming ASCII white space.

Plan: each text is split once into a narrow table of (host, page, line) hashes,
one row per distinct line of a page. Counting distinct pages per (host, line)
is a two-step aggregation keyed by (host, line, page) and then (host, line), so
a hot host or a line that stands on every page is pre-aggregated in each task.
The boilerplate hashes are gathered per page (never per host) and joined to the
documents on the page hash; the join can be split when one page has many copies.

Defined cases: a null host or null text is left as it is; a host with fewer than
``min_seen`` distinct pages can have no boilerplate; lines without a word are kept; a page whose every line is dropped keeps an empty
text; an empty table gives an empty result. Input columns named as result
columns are replaced by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probelens.llm.common import HAS_WORD, identity, lines, staged, without

BLANKS = " \t\n\u000b\f\r"
RESULT = ("n_lines", "n_dropped")
RATIO = 0.02
MIN_SEEN = 5


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(BLANKS)))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_seen: int = MIN_SEEN) -> DataFrame:
    """``docs`` with ``text`` cleaned, plus n_lines and n_dropped (lines of the input text)."""
    docs = without(docs, *RESULT)
    page = identity(F.col(host), F.col(text))
    spoken = F.filter(lines(F.col(text)), lambda x: x.rlike(HAS_WORD))
    usable = docs.where(F.col(host).isNotNull() & F.col(text).isNotNull())
    on_page = staged(usable.select(F.col(host).alias("host"), page.alias("page"), F.explode_outer(F.array_distinct(F.transform(spoken, _line_hash))).alias("line")).distinct())

    pages = on_page.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    seen = on_page.where("line is not null").groupBy("host", "line").agg(F.count("*").alias("seen"))
    common = seen.join(pages, "host").where((F.col("seen") >= min_seen) & (F.col("seen") > F.col("pages") * F.lit(ratio))).select("host", "line")
    # Written and merged, not broadcast: they grow with the pages, and the copies of one page can be split.
    drops = staged(on_page.join(common, ["host", "line"]).groupBy("page").agg(F.collect_set("line").alias("__drops")))

    keyed = docs.withColumn("__page", F.when(F.col(host).isNotNull() & F.col(text).isNotNull(), page))
    found = keyed.join(drops.withColumnRenamed("page", "__page").hint("merge"), "__page", "left")
    gone = lambda x: x.rlike(HAS_WORD) & F.array_contains(F.col("__drops"), _line_hash(x))
    kept = F.filter(lines(F.col(text)), lambda x: ~gone(x))
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines(F.col(text)))).cast("long")
    marked = found.withColumn("n_lines", n_lines).withColumn("__kept", F.when(F.col("__drops").isNotNull(), kept))
    n_dropped = F.when(F.col("__kept").isNull(), 0).otherwise(F.col("n_lines") - F.size("__kept")).cast("long")
    cleaned = F.when(F.col("__kept").isNull(), F.col(text)).otherwise(F.array_join("__kept", "\n"))
    return marked.select(*[cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns], "n_lines", n_dropped.alias("n_dropped"))
