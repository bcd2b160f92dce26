"""Reach: how many distinct people a link was shown to, by way of the people who passed it on."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.plans.skew import SkewOptions, fits_broadcast, heavy_keys, skew_join, stored

LIST = 1000  # the longest list of a source's followers, and of a url's sources, that is gathered in a row


def _skew(options: SkewOptions | None, left_keys: DataFrame, right_keys: DataFrame) -> SkewOptions:
    """Look for heavy keys in the given tables instead of in results that would have to be computed for it."""
    return replace(options or SkewOptions(), left_keys=left_keys, right_keys=right_keys)


def _sharers(requests: DataFrame, sharers: DataFrame, options: SkewOptions | None) -> DataFrame:
    """Distinct (url, source) pairs of the requested urls."""
    asked = requests.select("url").distinct()
    return sharers.select("url", "source").join(asked, "url", "left_semi").distinct()


def _followed(pairs: DataFrame, followers: DataFrame) -> DataFrame:
    """The follower rows of the sources in ``pairs`` only, which is told before anything is shuffled by follower."""
    return followers.select("source", "follower").join(pairs.select("source").distinct(), "source", "left_semi")


def _answer(requests: DataFrame, counts: DataFrame, name: str, options: SkewOptions | None) -> DataFrame:
    joined = skew_join(requests, counts, ["url"], "left", options, unique_right=True)
    return joined.select(*requests.columns, F.coalesce(name, F.lit(0).cast("long")).alias(name))


def _expanded(pairs: DataFrame, sharers: DataFrame, followers: DataFrame, options: SkewOptions | None) -> DataFrame:
    """Reach by lists: a source's followers travel to its urls as one row, and are told apart where a url's lists meet.

    Urls with more than ``LIST`` sources or with a source of more followers are answered by rows, a follower each.
    """
    pairs = stored(pairs)
    lists = stored(_followed(pairs, followers).groupBy("source").agg(F.collect_set("follower").alias("followers")))
    long = lists.where(F.size("followers") > LIST).select("source")
    many = pairs.groupBy("url").agg(F.count("*").alias("n")).where(F.col("n") > LIST).select("url")
    large = stored(many.unionByName(pairs.join(long, "source", "left_semi").select("url")).distinct())
    if large.isEmpty():
        return _by_lists(pairs, lists, sharers, options)
    short = lists.where(F.size("followers") <= LIST)
    listed = _by_lists(pairs.join(large, "url", "left_anti"), short, sharers, options)
    return listed.unionByName(_by_rows(pairs.join(large, "url", "left_semi"), sharers, followers, options))


def _by_lists(pairs: DataFrame, lists: DataFrame, sharers: DataFrame, options: SkewOptions | None) -> DataFrame:
    paths = skew_join(pairs, lists, ["source"], options=_skew(options, sharers, lists), unique_right=True)
    met = paths.select("url", "followers").repartition("url").groupBy("url").agg(F.collect_list("followers").alias("met"))
    return met.select("url", F.size(F.array_distinct(F.flatten("met"))).cast("long").alias("reach"))


def _by_rows(pairs: DataFrame, sharers: DataFrame, followers: DataFrame, options: SkewOptions | None) -> DataFrame:
    edges = _followed(pairs, followers)  # repeated edges do not matter below
    paths = skew_join(pairs, edges, ["source"], options=_skew(options, sharers, followers))
    return paths.groupBy("url").agg(F.countDistinct("follower").alias("reach"))


def _around_largest(pairs: DataFrame, sharers: DataFrame, followers: DataFrame,
                    options: SkewOptions | None) -> DataFrame:
    """Reach without listing the followers of the largest source of each url.

    That source adds its number of followers; the followers of the others are listed and those it has too are left out.
    Results that are used several times are written once.
    """
    edges = _followed(pairs, followers).distinct()
    sizes = edges.groupBy("source").agg(F.count("*").alias("n"))
    by_source = _skew(options, sharers, followers)
    sized = stored(skew_join(pairs, sizes, ["source"], options=by_source, unique_right=True))
    largest = sized.groupBy("url").agg(F.max(F.struct("n", "source")).alias("top")).select("url", "top.*")
    base = largest.withColumnRenamed("source", "base").withColumnRenamed("n", "base_n")
    others = skew_join(sized.select("url", "source"), base, ["url"], options=_skew(options, sharers, base),
                       unique_right=True)
    others = stored(others.where(F.col("source") != F.col("base")).select("url", "base", "source"))

    # What a source adds to a base is worked out once per pair of them, whatever the number of urls with that pair.
    listed = stored(skew_join(others.select("base", "source").distinct(), edges, ["source"],
                              options=_skew(options, others, followers)))
    known = edges.select(F.col("source").alias("base"), "follower", F.lit(True).alias("known"))
    checked = skew_join(listed, known, ["base", "follower"], "left", options, unique_right=True)
    new = stored(checked.where(F.col("known").isNull()).drop("known"))
    paths = skew_join(others, new, ["base", "source"], options=options)
    added = paths.groupBy("url").agg(F.countDistinct("follower").alias("added"))
    joined = base.join(added, "url", "left")
    return joined.select("url", (F.col("base_n") + F.coalesce("added", F.lit(0))).alias("reach"))


def reach(requests: DataFrame, sharers: DataFrame, followers: DataFrame,
          options: SkewOptions | None = None) -> DataFrame:
    """Each request (with a ``url``) and the number of distinct followers of the sources that shared it; 0 if none.

    ``sharers`` has ``(url, source)`` and ``followers`` has ``(source, follower)``; repeated pairs do not matter.  Equal
    urls are answered once.  Where some source has a large share of all followers, its list is not repeated for every
    url that it shared.
    """
    pairs = _sharers(requests, sharers, options)
    large = False
    if (options is not None and options.always) or not fits_broadcast(followers):
        large = bool(heavy_keys(followers, ["source"], options or SkewOptions()))
    counts = (_around_largest if large else _expanded)(pairs, sharers, followers, options)
    return _answer(requests, counts, "reach", options)


def active_sources(requests: DataFrame, sharers: DataFrame, followers: DataFrame,
                   options: SkewOptions | None = None) -> DataFrame:
    """Each request and the number of distinct sources that shared its url and have at least one follower."""
    pairs = _sharers(requests, sharers, options)
    followed = _followed(pairs, followers).select("source").distinct()
    counts = skew_join(pairs, followed, ["source"], options=_skew(options, sharers, followers), unique_right=True)
    counts = counts.groupBy("url").agg(F.count("*").alias("sources"))
    return _answer(requests, counts, "sources", options)
