"""URL filters by dated lists: every capture is judged by the entries active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenolens.llm.common import broadcast_if_small, shared_table

#: Intervals are cut at multiples of so many days, which makes the as-of join an equi-join.
PERIOD_DAYS = 64
#: Day after the last one; the end of an entry that was never removed.
FOREVER = 1 << 30
BROADCAST_BYTES = 32 << 20


def host(url: Column) -> Column:
    """Lower-case host without port and user; null if there is none."""
    authority = F.lower(F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\]*)", 1))
    return F.nullif(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"\.?(:\d*)?$", ""), F.lit(""))


def path(url: Column) -> Column:
    """Path without query and fragment; "/" if empty."""
    found = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\\]*([^?#]*)", 1)
    return F.when(found == "", "/").otherwise(found)


def patterns(url: Column) -> Column:
    """The patterns that cover a URL: its host and the domains above it, and the host with each leading part of the path."""
    labels, steps = F.split(host(url), r"\."), F.split(path(url), "/")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    leading = F.transform(F.sequence(F.lit(2), F.greatest(F.size(steps), F.lit(2))), lambda i: F.concat(
        host(url), F.array_join(F.slice(steps, 1, i), "/"), F.when(i < F.size(steps), "/").otherwise("")))
    return F.when(host(url).isNull(), F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(domains, F.array(F.concat(host(url), F.lit("/"))), leading)))


def validity(events: DataFrame) -> DataFrame:
    """(list, pattern, allow, from_day, to_day) of dated ``events`` (list, pattern, allow, day, added).

    An entry holds from the day of its addition up to, but without, the day of the
    list's next event for the pattern. Of events on one day the removal counts,
    then the allowing entry; equal events count once. Events without a list,
    pattern or day are void."""
    known = events.select("list", "pattern", "allow", "day", "added").dropna(subset=["list", "pattern", "day"])
    known = known.groupBy("list", "pattern", "day").agg(
        F.coalesce(F.bool_and("added"), F.lit(False)).alias("added"),
        F.coalesce(F.bool_or("allow"), F.lit(False)).alias("allow"))
    nxt = F.lead("day").over(Window.partitionBy("list", "pattern").orderBy("day"))
    return (known.withColumn("to_day", F.coalesce(nxt, F.lit(FOREVER)))
            .filter("added").select("list", "pattern", "allow", F.col("day").alias("from_day"), "to_day"))


def judge(captures: DataFrame, events: DataFrame, id_col: str = "page_id", url_col: str = "url", day_col: str = "day",
          period_days: int = PERIOD_DAYS) -> DataFrame:
    """(page_id, url, day, host, n_active, lists, allowed), one row per row of ``captures``.

    ``n_active`` counts the entries that cover the URL and are active on ``day``,
    ``lists`` names their lists in order. A capture is allowed if an allowing entry
    is among them or none is active. A URL without a host and a capture without a
    day match no entry and are allowed. Rows that repeat id, URL and day share
    their result; other columns are not looked at.

    Entries are cut into periods and joined by pattern and period, so that neither
    an entry's history nor a host's captures meet in one key; the narrow matches
    are counted per capture. Entries are broadcast up to a checked size.
    """
    last = captures.agg(F.max(day_col)).first()[0]
    entries = validity(events).filter(F.col("from_day") <= F.lit(0 if last is None else last))
    until = F.least(F.col("to_day") - 1, F.lit(0 if last is None else last))
    entries = shared_table(entries.withColumn("period", F.explode(F.sequence(
        F.floor(F.col("from_day") / period_days), F.floor(until / period_days)))), "list_entries")
    urls = captures.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(day_col).alias("day"))
    keyed = (urls.select("page_id", "url", "day", F.floor(F.col("day") / period_days).alias("period"),
                         F.explode(patterns(F.col("url"))).alias("pattern")).distinct())
    found = (keyed.join(broadcast_if_small(entries, BROADCAST_BYTES, 160), ["pattern", "period"])
             .filter((F.col("from_day") <= F.col("day")) & (F.col("day") < F.col("to_day")))
             .groupBy("page_id", "url", "day").agg(
                 F.count("*").alias("n_active"), F.array_sort(F.collect_set("list")).alias("lists"),
                 F.bool_or("allow").alias("allow")))
    u, f = urls.alias("u"), found.alias("f")
    same = (F.col("u.page_id").eqNullSafe(F.col("f.page_id")) & (F.col("u.url") == F.col("f.url"))
            & (F.col("u.day") == F.col("f.day")))
    return u.join(f, same, "left").select(
        "u.page_id", "u.url", "u.day", host(F.col("u.url")).alias("host"),
        F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"),
        F.coalesce("lists", F.array().cast("array<string>")).alias("lists"),
        F.coalesce("allow", F.lit(True)).alias("allowed"))
