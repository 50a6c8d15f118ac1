"""Archive records of the kind "not modified" resolved to the response they stand for.

A revisit record says that a page was the same as before. It is joined, by
canonical URL, to the latest full response before it. The validators of both
are compared, and the headers that a 304 answer may change are taken over.

The as-of join holds for a URL of any number of records: the records are dealt
out in sorted ranges of URL and time, the latest response is carried forward
within each range, and the last response of a URL that runs on into the next
range is handed over: one row per range at most, which is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.scale import written

# Headers that a 304 response may update in the stored response.
PERMITTED = (
    "cache-control",
    "content-location",
    "date",
    "etag",
    "expires",
    "last-modified",
    "vary",
)

# Query parameters that do not name a page.
TRACKING = r"(?:utm_[a-z]+|ref|gclid|fbclid)"

RESOLVED, CHANGED, UNCHECKED, MISSING = "resolved", "changed", "unchecked", "missing"


def canonical_url(url: str | Column) -> Column:
    """Host and path by which captures of one page are brought together.

    Scheme, user, default port, `www.` and `m.`, fragment, tracking parameters
    and a final slash go; the host is in lower case and the remaining
    parameters are sorted. What has no host is kept as it is but for blanks.
    """
    whole = F.btrim(F.col(url) if isinstance(url, str) else url)
    bare = F.regexp_replace(whole, r"#.*$", "")
    after = F.regexp_replace(bare, r"^(?i:https?)://(?:[^/?@]*@)?", "")
    host = F.lower(F.regexp_extract(after, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(?:80|443)$", ""), r"^(?:www|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(after, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(after, r"\?(.*)$", 1)
    kept = F.array_sort(
        F.filter(
            F.split(query, "&"),
            lambda p: (p != "") & ~p.rlike(rf"^(?i:{TRACKING})(?:=|$)"),
        )
    )
    rest = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(after == bare, bare).otherwise(F.concat(host, path, rest))


def _tag(value: Column) -> Column:
    """An entity tag without the mark of weakness, quotes and blanks; NULL if nothing is left."""
    bare = F.regexp_replace(F.btrim(value), r'^(?:W/)?"?|"$', "")
    return F.when(bare != "", bare)


def _outcome(found: Column, etag: Column, modified: Column) -> Column:
    """Entity tags decide where both have one, else times of change, else nothing is checked."""
    own, theirs = _tag(etag), _tag(found["etag"])
    return (
        F.when(found.isNull(), MISSING)
        .when(own.isNotNull() & theirs.isNotNull(), F.when(own == theirs, RESOLVED).otherwise(CHANGED))
        .when(
            modified.isNotNull() & found["modified"].isNotNull(),
            F.when(modified == found["modified"], RESOLVED).otherwise(CHANGED),
        )
        .otherwise(UNCHECKED)
    )


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored headers, names in lower case, with the permitted ones of the update in their place."""
    def lowered(headers: Column) -> Column:
        entries = F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>"))
        return F.transform(
            entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
        )

    def first_of_each(entries: Column) -> Column:
        """Names that differ in case only: the first in order counts."""
        ordered = F.array_sort(entries)
        names = F.transform(ordered, lambda e: e["key"])
        return F.filter(ordered, lambda e, i: F.array_position(names, e["key"]) == i + 1)

    new = first_of_each(F.filter(lowered(update), lambda e: e["key"].isin(*PERMITTED)))
    names = F.transform(new, lambda e: e["key"])
    kept = F.filter(first_of_each(lowered(stored)), lambda e: ~F.array_contains(names, e["key"]))
    return F.map_from_entries(F.array_sort(F.concat(kept, new)))


def resolve_revisits(
    records: DataFrame,
    record: str = "record_id",
    kind: str = "kind",
    url: str = "url",
    time: str = "time",
    etag: str = "etag",
    modified: str = "last_modified",
    headers: str = "headers",
    digest: str = "digest",
) -> DataFrame:
    """One row per revisit record with the response it stands for.

    Columns: `record`, `page` (the canonical URL), `response` (the latest
    response with an earlier time; of equal times the greatest `record`),
    `outcome`, and `digest` and `headers` of the response, the latter merged
    with the permitted ones of the revisit. The outcome is "resolved" where
    the validators agree, "changed" where they do not, "unchecked" where
    either side has none, "missing" without an earlier response; digest and
    headers are NULL in the second and fourth case. A revisit with a NULL URL
    or time is "missing"; such responses are not found. Records of other kinds
    are left out. Repeated records give repeated rows; an empty table gives none.
    """
    is_response = F.col(kind) == "response"
    entry = F.struct(
        F.col(time).alias("time"),
        F.col(record).alias("response"),
        F.col(etag).alias("etag"),
        F.col(modified).alias("modified"),
        F.col(digest).alias("digest"),
        F.col(headers).alias("headers"),
    )
    rows = records.filter(F.col(kind).isin("response", "revisit")).select(
        canonical_url(url).alias("page"),
        F.col(time).alias("time"),
        is_response.alias("full"),
        F.col(record).alias("record"),
        F.col(etag).alias("etag"),
        F.col(modified).alias("modified"),
        F.when(~is_response, F.col(headers)).alias("update"),
        F.when(is_response, entry).alias("entry"),
    )
    known = F.col("page").isNotNull() & F.col("time").isNotNull()
    order = ["page", "time", "full", "record"]
    ranged = written(
        rows.filter(known).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()),
        "records",
    )
    # A revisit comes before a response of the same time, which is not earlier than it.
    so_far = (
        Window.partitionBy("_range", "page").orderBy("time", "full", "record")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    here = ranged.withColumn("_here", F.last("entry", ignorenulls=True).over(so_far)).filter("not full")
    last = ranged.groupBy("page", "_range").agg(
        F.max_by("entry", F.when(F.col("full"), F.struct("time", "record"))).alias("entry")
    )
    before = Window.partitionBy("page").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    handed = (
        last.withColumn("_handed", F.last("entry", ignorenulls=True).over(before))
        .filter("_handed is not null")
        .select("page", "_range", "_handed")
    )
    found = here.join(F.broadcast(handed), ["page", "_range"], "left").withColumn(
        "found", F.coalesce("_here", "_handed")
    )
    lost = rows.filter(~known & ~F.col("full")).withColumn(
        "found", F.lit(None).cast(found.schema["found"].dataType)
    )
    columns = ["record", "page", "etag", "modified", "update", "found"]
    revisits = found.select(*columns).unionByName(lost.select(*columns))
    outcome = _outcome(F.col("found"), F.col("etag"), F.col("modified"))
    valid = outcome.isin(RESOLVED, UNCHECKED)
    return revisits.select(
        F.col("record").alias(record),
        "page",
        F.col("found.response").alias("response"),
        outcome.alias("outcome"),
        F.when(valid, F.col("found.digest")).alias("digest"),
        F.when(valid, merged_headers(F.col("found.headers"), F.col("update"))).alias("headers"),
    )


def capture_records(pages: DataFrame) -> DataFrame:
    """Archive records as a crawl of `pages` would leave them: two for every page.

    Each page is fetched in full and asked for again under another spelling of
    its URL: a day later, or for every thirteenth page a day before. Every
    third page has no entity tag and every eleventh was changed in between.
    """
    number, body = F.col("page_id"), F.col("html")
    day = 86_400
    digest = F.md5(body.cast("binary"))
    tag = F.when(F.pmod(number, 3) != 2, F.concat(F.lit('"'), digest, F.lit('"')))
    changed = F.pmod(number, 11) == 0
    date = (number * 60).cast("string")
    first = F.struct(
        (number * 2).alias("record_id"),
        F.lit("response").alias("kind"),
        F.col("url").alias("url"),
        (number * 60 + 10 * day).alias("time"),
        tag.alias("etag"),
        F.when(F.pmod(number, 4) != 3, date).alias("last_modified"),
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html"),
            F.lit("Content-Length"), F.length(body).cast("string"),
            F.lit("Cache-Control"), F.lit("max-age=60"),
            F.lit("Date"), date,
        ).alias("headers"),
        digest.alias("digest"),
    )
    early = F.pmod(number, 13) == 0
    again = F.struct(
        (number * 2 + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        F.concat(F.regexp_replace("url", r"[#].*$", ""), F.lit("#again")).alias("url"),
        (number * 60 + F.when(early, 9 * day).otherwise(11 * day)).alias("time"),
        F.when(changed, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag)).alias("etag"),
        F.when(F.pmod(number, 4) != 3, F.when(changed, "0").otherwise(date)).alias("last_modified"),
        F.create_map(
            F.lit("cache-control"), F.lit("no-cache"),
            F.lit("content-length"), F.lit("0"),
            F.lit("Expires"), F.lit("never"),
        ).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return pages.select(F.inline(F.array(first, again)))
