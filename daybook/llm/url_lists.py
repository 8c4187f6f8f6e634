"""URL lists over time: every capture is judged by the entries active when it was fetched.

A list's dated additions and removals become intervals of validity per rule (a host
or a domain above it). A capture looks up its host and all domains above it as of its
fetch time. Both sides meet on the rule and the month, so neither a rule with a long
history nor a host with a third of all captures multiplies rows: a capture meets only
the intervals that touch its month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import picked
from daybook.sources.scratch import saved, scratch_folder

ADD, REMOVE = "add", "remove"
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def host_of(url: Column) -> Column:
    """The host in lower case; null if the text is no URL with one."""
    return F.nullif(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def domains_of(host: Column) -> Column:
    """The host and the domains above it, the top-level one left out unless it is the host."""
    labels = F.split(host, r"\.")
    starts = F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1)))
    return F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def validity(entries: DataFrame) -> DataFrame:
    """``list, rule, since, until`` from ``list, rule, action, at``; ``until`` is null while it holds.

    An entry decides until the next one of its list and rule. Of entries of one
    moment a removal wins. Unknown actions and entries with a null are ignored.
    """
    at_once = (
        entries.select("list", F.lower("rule").alias("rule"), "action", "at")
        .where(F.col("action").isin(ADD, REMOVE))
        .dropna()
        .groupBy("list", "rule", "at")
        .agg(F.max("action").alias("action"))  # "remove" comes after "add"
    )
    order = Window.partitionBy("list", "rule").orderBy("at")
    return (
        at_once.withColumn("until", F.lead("at").over(order))
        .where(F.col("action") == ADD)
        .select("list", "rule", F.col("at").alias("since"), "until")
    )


def _month(day: Column) -> Column:
    return (F.year(day) * 12 + F.month(day)).cast("int")


def judge_captures(
    captures: DataFrame,
    entries: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    at_col: str = "fetched_at",
) -> DataFrame:
    """One row per capture: ``page_id, url, fetched_at, host, n_active, lists, listed``.

    ``lists`` joins the names of the lists with an active entry, in order. A capture
    without host or fetch time matches nothing. Repeated rows are judged each. Without
    entries nothing is listed; an empty table gives no rows.
    """
    root = scratch_folder(captures.sparkSession)
    rows = picked(captures, page_id=id_col, url=url_col, fetched_at=at_col)
    rows = saved(
        rows.select(
            F.monotonically_increasing_id().alias("row_id"), "*", host_of(F.col("url")).alias("host")
        ),
        f"{root}/captures",
    )
    last = rows.agg(F.max("fetched_at")).first()[0]
    # An interval stands in every month that it touches, up to the last fetch.
    intervals = validity(entries).where(F.col("since") <= F.lit(last))
    months = F.sequence(_month(F.col("since")), _month(F.least(F.coalesce("until", F.lit(last)), F.lit(last))))
    intervals = saved(intervals.withColumn("month", F.explode(months)), f"{root}/intervals")
    asked = rows.where(F.col("host").isNotNull() & F.col("fetched_at").isNotNull()).select(
        "row_id", "fetched_at", _month(F.col("fetched_at")).alias("month"), F.explode(domains_of(F.col("host"))).alias("rule")
    )
    valid = (F.col("since") <= F.col("fetched_at")) & (F.col("until").isNull() | (F.col("fetched_at") < F.col("until")))
    found = saved(
        asked.join(intervals, ["rule", "month"])
        .where(valid)
        .groupBy("row_id")
        .agg(F.count("*").alias("n_active"), F.array_join(F.sort_array(F.collect_set("list")), ",").alias("lists")),
        f"{root}/found",
    )
    active = F.coalesce("n_active", F.lit(0)).cast("long")
    return rows.join(found, "row_id", "left").select(
        "page_id",
        "url",
        "fetched_at",
        "host",
        active.alias("n_active"),
        F.coalesce("lists", F.lit("")).alias("lists"),
        (active > 0).alias("listed"),
    )
