"""URL filters by temporal list join.

A filter list changes over time: dated entries add or remove a key (a host, a parent domain, or a host with leading path
segments) under a category. Entries become validity intervals per key and category; an as-of join evaluates every capture
against the intervals that hold at its fetch time, for all keys that its URL falls under. DataFrame operations only.

The list's side is broadcast if it has at most BROADCAST_ROWS intervals; beyond, the join shuffles on the key, where adaptive
execution splits hot hosts. Matches per capture are bounded by its keys and the categories.

Keys of entries are normalised as hosts and paths of captures are (`listed_key`), so "Ads.Example.com.", "ads.example.com:443/" and
"https://ads.example.com" are one key.

Defined results: captures with a null or unparsable URL, or without fetch time, match nothing and stay in the result; entries with a
null key, date or category, or no host, are void; an empty list leaves all captures unlisted, an empty table of captures gives an empty result; several entries of a key, category and date: a removal wins; captures of one id at several times or
of several URLs are evaluated each for itself, whole repeats (id, URL and time) are one; other columns are ignored. URLs are
tested under as many leading path segments as the list's longest key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checked_broadcast


def host(url: Column) -> Column:
    """Lower-case host without user, port and trailing dots; empty if there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.rtrim(found, F.lit(".")))


def keys(url: Column, segments: int) -> Column:
    """All keys a URL falls under: its host and parent domains (two labels at least), and the host with up to `segments` leading path segments."""
    labels = F.split(host(url), r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)?", 1)
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    depth = F.least(F.size(parts), F.lit(segments))
    counts = F.when(depth > 0, F.sequence(F.lit(1), F.greatest(depth, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    prefixes = F.transform(counts, lambda k: F.concat(host(url), F.lit("/"), F.array_join(F.slice(parts, F.lit(1), k), "/")))
    return F.when(host(url) != "", F.array_distinct(F.concat(domains, prefixes))).otherwise(F.array().cast("array<string>"))


def listed_key(key: Column) -> Column:
    """A list entry's key as captures have theirs: without scheme, user, port, query, leading "*." or dots, trailing dots and empty path
    segments; the host in lower case, the path as it is. Null where no host is left."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(key), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?#].*$", "")
    name = F.regexp_replace(F.regexp_replace(F.substring_index(bare, "/", 1), r"^.*@", ""), r":[0-9]*$", "")
    name = F.lower(F.regexp_replace(F.regexp_replace(name, r"^(?:\*?\.)+", ""), r"\.+$", ""))
    path = F.filter(F.slice(F.split(bare, "/"), 2, 1 << 20), lambda s: s != "")
    return F.when(name != "", F.array_join(F.concat(F.array(name), path), "/"))


def intervals(entries: DataFrame) -> DataFrame:
    """key, category, valid_from, valid_to (null: open) from dated entries (key, category, dated, action 'add' or 'remove')."""
    clean = entries.select(listed_key(F.col("key")).alias("key"), "category", "dated", "action").where("key IS NOT NULL AND category IS NOT NULL AND dated IS NOT NULL")
    daily = clean.groupBy("key", "category", "dated").agg(F.min(F.when(F.col("action") == "remove", 0).otherwise(1)).alias("on"))
    order = W.partitionBy("key", "category").orderBy("dated")
    steps = daily.withColumn("before", F.coalesce(F.lag("on").over(order), F.lit(0))).where(F.col("on") != F.col("before"))
    return steps.withColumn("valid_to", F.lead("dated").over(order)).where("on = 1").select("key", "category", F.col("dated").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """One row per capture (id, URL, time): id, url, time, listed, n_active, categories (sorted, comma-joined), key (the longest active one), since."""
    segments = entries.agg(F.max(F.size(F.split(listed_key(F.col("key")), "/")))).first()[0] or 1
    seen = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(time_col).alias("at"))
    spread = seen.select("id", "url", "at", F.explode_outer(keys(F.col("url"), segments - 1)).alias("key"))
    listed = checked_broadcast(intervals(entries))
    active = (spread["key"] == listed["key"]) & (spread["at"] >= listed["valid_from"]) & (listed["valid_to"].isNull() | (spread["at"] < listed["valid_to"]))
    joined = spread.join(listed, active, "left").select("id", "url", "at", listed["key"].alias("key"), "category", "valid_from")
    best = F.max(F.when(F.col("key").isNotNull(), F.struct(F.length("key").alias("n"), F.col("key"), F.col("valid_from"))))
    hit = F.when(F.col("key").isNotNull(), F.struct("key", "category"))
    out = joined.groupBy("id", "url", "at").agg(F.size(F.collect_set(hit)).cast("long").alias("n_active"), F.array_join(F.sort_array(F.collect_set("category")), ",").alias("categories"), best.alias("best"))
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("at").alias(time_col), (F.col("n_active") > 0).alias("listed"), "n_active", "categories", F.col("best.key").alias("key"), F.col("best.valid_from").alias("since"))
