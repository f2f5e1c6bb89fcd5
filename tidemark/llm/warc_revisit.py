"""Resolution of not-modified revisits in crawl records.

A revisit says that a page has not changed since an earlier capture, and carries no body. It is joined, as of its time, to
the latest earlier full response with the same canonical URL. The two must agree on their validators, and the headers that
a not-modified response may update replace those of the stored one.

A URL may have a third of all records, so no URL is gathered in one task: records are dealt by range of (URL, time, id),
which cuts hot URLs too; inside a range the latest response comes from a window, and what an earlier range of the same URL
ends with is carried over by a second, small window over one row per range and URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved

# Query parameters that do not name another page, and header fields that describe the body or the connection,
# which a not-modified response must not change.
TRACKING = ("utm_[a-z]+", "ref", "gclid", "fbclid")
FIXED_HEADERS = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade",
)


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, without default port, leading `www.`, fragment, tracking parameters or trailing slash.

    http and https are one. The other parameters are sorted. Angle brackets around a URL go. A URL that does not start with
    a scheme and `://` is its own key. A null URL stays null.
    """
    url = F.trim(F.regexp_replace(F.trim(url), "^<(.*)>$", "$1"))
    bare = F.regexp_replace(url, "#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(" + "|".join(TRACKING) + ")(=|$)"))
    )
    key = F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(bare.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), key).otherwise(url)


def _weak(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def _lowered(headers: Column) -> Column:
    """Header fields by their names in lower case; of names that then are one, the last field stays."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    named = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    backwards = F.reverse(F.transform(named, lambda e: e["key"]))
    last = F.filter(named, lambda e, i: i == F.size(headers) - F.array_position(backwards, e["key"]))
    return F.map_from_entries(last)


def resolve(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """(record_id, url_key, outcome, refers_to, digest, headers), one row per revisit of `records`.

    `records` is (record_id long, url, captured timestamp, status int, etag, last_modified, digest, headers map<string,
    string>). Status 200 with a digest is a full response, 304 a revisit; other records count for nothing. Earlier means a
    smaller time, or the same time and a smaller record_id. outcome is

    * `resolved`: the etags are equal, weak ones included, or without both etags the last_modified values are;
    * `unchecked`: no validator is on both sides; it refers to the response all the same;
    * `changed`: the validators differ;
    * `missing`: the URL has no earlier response.

    Only `resolved` and `unchecked` have refers_to, the digest of the response and merged headers: the response's, with
    those of the revisit in place but for `FIXED_HEADERS`; names are compared in lower case, and of fields whose names differ only in case the last counts. Null headers are empty. A null
    URL has no earlier response; a null time comes before all others. Repeated records are resolved alike. Other columns
    are ignored; an empty table gives no rows.
    """
    full = (F.col("status") == 200) & F.col("digest").isNotNull()
    events = records.where(full | (F.col("status") == 304)).select(
        F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url")).alias("url_key"), "captured",
        (F.col("status") == 200).alias("full"), "etag", "last_modified", "digest", _lowered(F.col("headers")).alias("headers"),
    )
    order = ("url_key", "captured", "record_id")
    ranged = events.repartitionByRange(partitions, *order) if partitions else events.repartitionByRange(*order)
    ranged = saved(ranged.withColumn("range", F.spark_partition_id()), "records")
    response = F.struct("record_id", "etag", "last_modified", "digest", "headers")
    # full responses come first where id and time repeat
    inside = Window.partitionBy("range", "url_key").orderBy("captured", "record_id", F.desc("full"))
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    seen = ranged.withColumn("stored", F.last(F.when(F.col("full"), response), ignorenulls=True).over(inside))
    ends = ranged.where("full").groupBy("range", "url_key").agg(
        F.max_by(response, F.struct("captured", "record_id")).alias("end")
    )
    touched = ranged.groupBy("range", "url_key").agg(F.first(F.lit(1)).alias("one")).drop("one")
    earlier = Window.partitionBy("url_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        touched.join(ends, ["range", "url_key"], "left")
        .withColumn("before", F.last("end", ignorenulls=True).over(earlier))
        .where("before is not null")
        .select("range", "url_key", "before")
    )
    revisits = seen.where(~F.col("full")).join(carried, ["range", "url_key"], "left")
    revisits = revisits.withColumn("stored", F.coalesce("stored", "before")).withColumn(
        "stored", F.when(F.col("url_key").isNotNull(), F.col("stored"))
    )
    by_etag = F.col("etag").isNotNull() & F.col("stored.etag").isNotNull()
    by_time = F.col("last_modified").isNotNull() & F.col("stored.last_modified").isNotNull()
    same = F.when(by_etag, _weak(F.col("etag")) == _weak(F.col("stored.etag"))).when(
        by_time, F.col("last_modified") == F.col("stored.last_modified")
    )
    outcome = (
        F.when(F.col("stored").isNull(), "missing")
        .when(same.isNull(), "unchecked")
        .when(same, "resolved")
        .otherwise("changed")
    )
    allowed = F.map_filter("headers", lambda k, _: ~k.isin(*FIXED_HEADERS))
    kept = F.map_filter("stored.headers", lambda k, _: ~F.array_contains(F.map_keys(allowed), k))
    found = F.col("outcome").isin("resolved", "unchecked")
    return revisits.withColumn("outcome", outcome).select(
        "record_id", "url_key", "outcome", F.when(found, F.col("stored.record_id")).alias("refers_to"),
        F.when(found, F.col("stored.digest")).alias("digest"), F.when(found, F.map_concat(kept, allowed)).alias("headers"),
    )
