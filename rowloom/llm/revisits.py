"""Resolve not-modified revisits of a web archive to the full responses they stand for.

Records have record_id, url, captured, kind ("response" or "revisit"), status, etag, last_modified and headers (a map). A
revisit is joined as of its time to the latest earlier full response (status 200) of the same canonical address. It stands for
that response if their validators agree: the entity tags, compared weakly, where the revisit has one; else the times of last
modification. Then it gets the response's headers, with those that a not-modified answer may renew (``RENEWED``) taken from
the revisit.

The as-of join is cut along time, so one hot address never lands in one task: times are cut into ranges of equal numbers of
records; inside a range a window finds the last response, and a window over one row per address and range carries the last
response of the ranges before.

Defined results: one row per revisit. Outcomes are "resolved", "no_earlier_response" (also for records without an address or
time), "no_validator" (the revisit has none, or none that the response has) and "validator_mismatch". A response at the same
time is not earlier. Of responses at one time the one with the greatest record_id counts. Repeated revisits are resolved
alike. Times are numbers, timestamps, dates, or texts of these; other texts are no time. Header names are compared in lower case; of names that differ in case alone the smallest spelling counts. Null headers
are none. Extra columns are ignored unless named in ``carried``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import cut_points, shuffle_parts, stored, with_bucket

# Headers that a 304 answer may renew, and parameters that track visitors.
RENEWED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = "^(utm_[a-z]*|ref|fbclid|gclid|sessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www and default port, path without a last slash, sorted parameters that do not track."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    start = "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?@]*@)?"
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, start + "([^/?]*)", 2)), ":(80|443)$", "")
    host = F.regexp_replace(host, "^www[0-9]*\\.", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, start + "[^/?]*", ""), "[?].*$", ""), "/+$", "")
    query = F.regexp_extract(bare, "[?](.*)$", 1)
    wanted = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING))
    joined = F.array_join(F.array_sort(wanted), "&")
    return F.concat(host, F.when(path == "", "/").otherwise(path), F.when(joined == "", "").otherwise(F.concat(F.lit("?"), joined)))


def lower_names(headers: Column) -> Column:
    """A header map with names in lower case, each once."""
    entries = F.array_sort(F.map_entries(headers))
    return F.aggregate(
        entries,
        F.expr("CAST(map() AS map<string,string>)"),
        lambda found, e: F.when(F.map_contains_key(found, F.lower(e["key"])), found).otherwise(
            F.map_concat(found, F.create_map(F.lower(e["key"]), e["value"]))
        ),
    )


def merged_headers(old: Column, new: Column) -> Column:
    """The response's headers, with those that may be renewed taken from the revisit."""
    renewed = F.map_filter(new, lambda name, value: name.isin(*RENEWED) & value.isNotNull())
    kept = F.map_filter(old, lambda name, value: ~F.array_contains(F.map_keys(renewed), name))
    return F.map_concat(kept, renewed)


def moment(records: DataFrame, name: str) -> Column:
    """A time as a number that rises with it: numbers as they are, timestamps, dates and their texts in seconds.

    Texts are numbers or dates as archives write them (2024-01-01T00:00:00Z); a text that is neither is no time.
    """
    kind, value = dict(records.dtypes)[name], F.col(f"`{name}`")
    if kind == "string":
        trimmed = F.trim(value)
        return F.coalesce(trimmed.try_cast("double"), F.unix_micros(trimmed.try_cast("timestamp")) / 1e6)
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(value.cast("timestamp")) / 1e6
    return value.cast("double")


def resolve_revisits(records: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """record_id, canonical_url, captured, outcome, refers_to, headers and the response's ``carried`` columns."""
    parts = shuffle_parts(records.sparkSession)
    tag = F.regexp_replace(F.trim("etag"), "^W/", "")
    rows = records.select(
        "record_id",
        canonical_url(F.col("url").cast("string")).alias("canonical_url"),
        "captured",
        (F.col("kind") == "revisit").alias("revisit"),
        F.when((F.col("kind") == "response") & (F.col("status") == 200), True).otherwise(False).alias("full"),
        F.struct(
            "record_id",
            F.when(tag != "", tag).alias("etag"),
            F.col("last_modified").cast("string").alias("last_modified"),
            lower_names(F.coalesce("headers", F.expr("CAST(map() AS map<string,string>)"))).alias("headers"),
            *[F.col(f"`{c}`").alias(c) for c in carried],
        ).alias("own"),
    ).filter("revisit OR full")
    rows = stored(rows.withColumn("place", moment(records, "captured")), "revisit-rows")
    known = rows.filter("canonical_url IS NOT NULL AND place IS NOT NULL")
    known = with_bucket(known, "place", cut_points(known, "place", parts), "bucket")
    response = F.when(F.col("full"), F.col("own"))
    order = [F.col("place"), F.col("full"), F.col("record_id")]  # at one time revisits stand before responses
    keys = ["canonical_url", "bucket"]
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = known.withColumn("found", F.last(response, ignorenulls=True).over(upto)).filter("revisit")
    lasts = known.filter("full").groupBy(*keys).agg(F.max_by("own", F.struct("place", "record_id")).alias("last"))
    asked = known.filter("revisit").select(*keys).distinct()
    ranges = asked.join(lasts, keys, "full")
    before = Window.partitionBy("canonical_url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = ranges.select(*keys, F.last("last", ignorenulls=True).over(before).alias("carry")).filter("carry IS NOT NULL")
    found = inside.join(carry, keys, "left").withColumn("found", F.coalesce("found", "carry"))
    columns = ["record_id", "canonical_url", "captured", "own", "found"]
    lost = rows.filter("revisit AND (canonical_url IS NULL OR place IS NULL)")
    lost = lost.withColumn("found", F.when(F.lit(False), F.col("own")))
    out = found.select(*columns).unionByName(lost.select(*columns))
    own_tag, old_tag = F.col("own.etag"), F.col("found.etag")
    own_time, old_time = F.col("own.last_modified"), F.col("found.last_modified")
    by_tag = F.when(old_tag.isNull(), "no_validator").when(old_tag == own_tag, "resolved").otherwise("validator_mismatch")
    by_time = F.when(old_time == own_time, "resolved").otherwise("validator_mismatch")
    by_time = F.when(own_time.isNull() | old_time.isNull(), "no_validator").otherwise(by_time)
    outcome = F.when(F.col("found").isNull(), "no_earlier_response").when(own_tag.isNotNull(), by_tag).otherwise(by_time)
    out = out.withColumn("outcome", outcome)
    good = F.col("outcome") == "resolved"
    return out.select(
        "record_id",
        "canonical_url",
        "captured",
        "outcome",
        F.when(good, F.col("found.record_id")).alias("refers_to"),
        F.when(good, merged_headers(F.col("found.headers"), F.col("own.headers"))).alias("headers"),
        *[F.when(good, F.col(f"found.`{c}`")).alias(c) for c in carried],
    )


def header_text(headers: Column) -> Column:
    """A header map as sorted lines."""
    line = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit(""))))
    return F.array_join(F.array_sort(line), "\n")
