"""URL filters by a temporal list join. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, small

#: Days of a time bucket: captures and intervals meet by domain and bucket.
BUCKET_DAYS = 32
FOREVER = "9999-12-31"


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user, port and final dot; empty if there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"\.?(:[0-9]*)?$", ""))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals (list, domain, since, until) of dated entries(list, domain, action, day): [since, until).

    An entry holds until the next one of its list and domain; only added ones give intervals. Of entries of one day a
    removal counts last. Null days and domains are left out.
    """
    known = entries.where("day is not null and domain is not null").select("list", F.lower("domain").alias("domain"), "action", "day").distinct()
    order = W.partitionBy("list", "domain").orderBy("day", "action")
    ends = known.withColumn("until", F.coalesce(F.lead("day").over(order), F.lit(FOREVER).cast("date")))
    return ends.where("action = 'add' and until > day").select("list", "domain", F.col("day").alias("since"), "until")


def parents(host: Column) -> Column:
    """The host and the domains above it, down to two labels: the names that an entry may be for."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def verdicts(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """For each distinct (host, day) of captures that an entry matches: host, day, lists (sorted, comma-joined).

    Captures are reduced to distinct hosts and days first, so a host that a third of them share is a few rows. The as-of
    join is an equality of domain and time bucket, with the interval as the residual condition.
    """
    bucket = lambda day: F.floor(F.unix_date(day) / BUCKET_DAYS)
    asked = captures.where("day is not null and host <> ''").select("host", "day").distinct()
    keys = asked.select("host", "day", bucket("day").alias("bucket"), F.explode(parents(F.col("host"))).alias("name"))
    # an interval is held in the buckets up to the last capture's
    last = F.lit(asked.agg(F.max("day")).first()[0]).cast("date")
    spans = intervals(entries).where(F.col("since") <= last)
    held = cut(spans.select("list", "domain", "since", "until", F.explode(F.sequence(bucket("since"), bucket(F.least(F.date_sub("until", 1), last)))).alias("b")))
    hit = keys.join(small(held), (F.col("name") == F.col("domain")) & (F.col("bucket") == F.col("b")) & (F.col("day") >= F.col("since")) & (F.col("day") < F.col("until")))
    return hit.groupBy("host", "day").agg(F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"))


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """captures(id, url, day) with host, blocked and lists: the lists with an entry for the host, or a domain above it,
    that is active on the day of the fetch.

    Null or malformed URLs have an empty host and aren't blocked, nor are captures without a day; lists is then empty.
    Repeated captures are judged each. Without entries nothing is blocked; an empty table gives no rows.
    """
    asked = captures.select("id", "url", "day", host_of(F.col("url")).alias("host"))
    found = verdicts(asked, entries).select(F.col("host").alias("h_"), F.col("day").alias("d_"), "lists")
    met = asked.join(found, (F.col("host") == F.col("h_")) & (F.col("day") == F.col("d_")), "left").drop("h_", "d_")
    return met.withColumn("blocked", F.col("lists").isNotNull()).withColumn("lists", F.coalesce("lists", F.lit("")))
