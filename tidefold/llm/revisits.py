"""Not-modified revisits of a web archive, resolved to the capture they repeat.

A revisit names no body: it says that a page was not modified.  It is joined as of its
date to the latest earlier full response of the same canonical URL.  The validators of
both must agree; then the stored headers are updated with those that a not-modified
answer may carry, and the body is the response's.

The as-of join works on one row for each (URL, date).  A URL's dates are cut at common
points in time, and only one row for each part carries over to later parts, so a URL with
very many captures is many tasks.  Bodies are moved once, when the answer is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Header fields that a not-modified answer may update.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]

# Query parameters that do not name a page.
TRACKING = r"^(utm_[a-z]+|ref|sid|sessionid|phpsessid|jsessionid)="

#: Parts into which time is cut.
PARTS = 256

RECORD = (
    "record_id bigint, type string, uri string, date timestamp, status int, "
    "headers map<string,string>, body string"
)


def canonical_url(uri: Column) -> Column:
    """Host, path and query that name a page; null for blank and null addresses.

    Scheme, default port, a leading www, fragment, trailing slashes and tracking
    parameters go; the host is lower-cased and parameters are sorted.
    """
    plain = F.regexp_replace(F.trim(uri), r"#.*$", "")
    rest = F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    query = F.array_join(
        F.array_sort(F.filter(query, lambda p: (p != "") & ~F.lower(p).rlike(TRACKING))), "&"
    )
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host != "", whole)


def lowered(headers: Column) -> Column:
    """Entries (key, value) with lower-cased names; of equal names the last one counts."""
    entries = F.transform(
        F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key: string, value: string>>")),
        lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value")),
    )
    return F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda f: f["key"] == e["key"]),
    )


def header(entries: Column, name: str) -> Column:
    return F.get(F.filter(entries, lambda e: e["key"] == name), F.lit(0))["value"]


def merged(stored: Column, fresh: Column) -> Column:
    """Stored entries updated with the permitted ones of a not-modified answer."""
    new = F.filter(fresh, lambda e: e["key"].isin(PERMITTED) & e["value"].isNotNull())
    old = F.filter(stored, lambda e: ~F.exists(new, lambda f: f["key"] == e["key"]))
    return F.map_from_entries(F.array_sort(F.concat(old, new)))


def validators(stored: Column, fresh: Column) -> Column:
    """True or false if entity tags, else modification dates, agree; null if none can be told."""
    tag = lambda e: F.regexp_replace(header(e, "etag"), r"^W/", "")
    same_tag = tag(stored) == tag(fresh)
    same_date = header(stored, "last-modified") == header(fresh, "last-modified")
    return F.coalesce(same_tag, same_date)


def latest_before(captures: DataFrame, asked: DataFrame) -> DataFrame:
    """(url, date, source): for each (url, date) of ``asked`` the latest capture before it.

    ``captures`` has (url, date, record_id); of captures at one date the greatest id counts.
    """
    points = (
        captures.groupBy("url", "date")
        .agg(F.max("record_id").alias("own"))
        .withColumn("asked", F.lit(False))
        .unionByName(
            asked.select("url", "date").distinct().select(
                "url", "date", F.lit(None).cast("bigint").alias("own"), F.lit(True).alias("asked")
            )
        )
    )
    cuts = asked.agg(
        F.percentile_approx(F.unix_micros("date"), [k / PARTS for k in range(1, PARTS)]).alias("c")
    ).first()["c"]
    part = F.size(F.filter(F.array(*[F.lit(c) for c in sorted(set(cuts or []))]).cast("array<bigint>"), lambda c: c <= F.unix_micros("date")))
    parted = points.withColumn("part", part)
    # Equal dates are not earlier: a frame of dates up to just before.
    inside = Window.partitionBy("url", "part").orderBy(F.unix_micros("date")).rangeBetween(
        Window.unboundedPreceding, -1
    )
    local = parted.withColumn("near", F.max(F.when(F.col("own").isNotNull(), F.struct("date", "own"))).over(inside))
    sums = parted.where("own is not null").groupBy("url", "part").agg(F.max(F.struct("date", "own")).alias("last"))
    every = parted.where("asked").select("url", "part").distinct().join(sums, ["url", "part"], "full")
    before = Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select("url", "part", F.max("last").over(before).alias("far"))
    return (
        local.where("asked")
        .join(carried, ["url", "part"], "left")
        .select("url", "date", F.coalesce("near.own", "far.own").alias("source"))
    )


def resolve(records: DataFrame) -> DataFrame:
    """(record_id, url, date, outcome, source_id, status, headers, body) of each revisit.

    ``records`` has the columns of RECORD; others are not looked at.  A full response is
    of type ``response`` with status 200 and a body.  The outcome is ``resolved``,
    ``unchecked`` (no validator to compare, resolved all the same), ``changed``
    (validators differ) or ``missing`` (no earlier response, or no address or date);
    the last two have no status, headers or body.  Header names are lower-cased.
    Revisits that are repeated are resolved each; rows that share a record id are one
    response.  An empty table gives no rows.
    """
    rows = records.select(
        "record_id", "type", canonical_url(F.col("uri")).alias("url"), "date", "status", "headers", "body"
    )
    full = rows.where(
        "type = 'response' and status = 200 and body is not null and record_id is not null "
        "and url is not null and date is not null"
    )
    revisits = rows.where("type = 'revisit'").select("record_id", "url", "date", "headers")
    asked = revisits.where("url is not null and date is not null")
    answer = latest_before(full.select("url", "date", "record_id"), asked)
    found = revisits.join(answer, ["url", "date"], "left")
    source = full.select(
        F.col("record_id").alias("source_id"),
        F.col("status").alias("s_status"),
        lowered(F.col("headers")).alias("s_headers"),
        F.col("body").alias("s_body"),
    ).dropDuplicates(["source_id"])
    joined = found.join(source, found["source"] == source["source_id"], "left").withColumn(
        "fresh", lowered(F.col("headers"))
    )
    agree = validators(F.col("s_headers"), F.col("fresh"))
    outcome = (
        F.when(F.col("source_id").isNull(), "missing")
        .when(agree, "resolved")
        .when(~agree, "changed")
        .otherwise("unchecked")
    )
    good = F.col("outcome").isin("resolved", "unchecked")
    return joined.withColumn("outcome", outcome).select(
        "record_id",
        "url",
        "date",
        "outcome",
        "source_id",
        F.when(good, F.col("s_status")).alias("status"),
        F.when(good, merged(F.col("s_headers"), F.col("fresh"))).alias("headers"),
        F.when(good, F.col("s_body")).alias("body"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl made of ``pages``: each is fetched, and asked for again a while later.

    The second fetch is a revisit.  Some servers name the body's entity tag, some an older
    one, some send a modification date only and some no validator.
    """
    n = F.col("page_id")
    when = lambda s: F.timestamp_seconds(s.cast("long"))
    first = n + 1_600_000_000
    tag = F.concat(F.lit('"'), F.md5(F.col("html").cast("binary")), F.lit('"'))
    modified = F.concat(F.lit("day "), (n % 1000).cast("string"))
    response = F.struct(
        (n * 2).alias("record_id"),
        F.lit("response").alias("type"),
        F.col("url").alias("uri"),
        when(first).alias("date"),
        F.lit(200).alias("status"),
        F.map_filter(
            F.create_map(
                F.lit("Content-Type"), F.lit("text/html"),
                F.lit("ETag"), F.when(n % 5 < 3, tag),
                F.lit("Last-Modified"), F.when(n % 5 < 4, modified),
                F.lit("Date"), first.cast("string"),
            ),
            lambda k, v: v.isNotNull(),
        ).alias("headers"),
        F.col("html").alias("body"),
    )
    later = first + n * 7919 % 20_000 + 1
    revisit = F.struct(
        (n * 2 + 1).alias("record_id"),
        F.lit("revisit").alias("type"),
        F.col("url").alias("uri"),
        when(later).alias("date"),
        F.lit(304).alias("status"),
        F.map_filter(
            F.create_map(
                F.lit("content-type"), F.lit("text/plain"),
                F.lit("etag"), F.when(n % 7 == 6, F.lit('"old"')).when(n % 5 < 3, F.concat(F.lit("W/"), tag)),
                F.lit("last-modified"), F.when(n % 5 < 4, modified),
                F.lit("date"), later.cast("string"),
                F.lit("expires"), (later + 60).cast("string"),
            ),
            lambda k, v: v.isNotNull(),
        ).alias("headers"),
        F.lit(None).cast("string").alias("body"),
    )
    return pages.select(F.explode(F.array(response, revisit)).alias("r")).select("r.*")


def op7_revisits(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    listed = F.array_join(
        F.transform(F.map_entries("headers"), lambda e: F.concat_ws(": ", e["key"], e["value"])), "\n"
    )
    return resolve(captures_of(pages)).select(
        "record_id", "url", "outcome", "source_id", "status", listed.alias("headers"),
        F.md5(F.col("body").cast("binary")).alias("body_md5"),
        F.length("body").cast("long").alias("body_chars"),
    )


ORACLE = r"""
with u as (select page_id as n, html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') as rest from pages),
v as (select n, html,
    regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www[0-9]*\.', '') as host,
    regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') as path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
      lambda p: p <> '' and not regexp_matches(lower(p), '^(utm_[a-z]+|ref|sid|sessionid|phpsessid|jsessionid)='))), '&') as query from u),
p as (select n, html, case when host <> '' then host || path || case when query <> '' then '?' || query else '' end end as url,
    n + 1600000000 as fetched, n + 1600000000 + n * 7919 % 20000 + 1 as later,
    case when n % 5 < 3 then '"' || md5(html) || '"' end as tag,
    case when n % 5 < 4 then 'day ' || (n % 1000) end as modified from v),
s as (select *, row_number() over (partition by url, fetched order by n desc) as k from p where html is not null and url is not null),
r as (select n * 2 + 1 as record_id, url, later, case when n % 7 = 6 then '"old"' else tag end as tag, modified from p),
j as (select r.*, s.n as sn, s.html, s.tag as stag, s.modified as smodified, s.fetched from r asof left join (select * from s where k = 1) s on r.url = s.url and r.later > s.fetched),
o as (select *, case when sn is null then 'missing'
    when coalesce(tag = stag, modified = smodified) then 'resolved'
    when coalesce(tag = stag, modified = smodified) = false then 'changed' else 'unchecked' end as outcome from j)
select record_id, url, outcome, sn * 2 as source_id,
  cast(case when outcome in ('resolved', 'unchecked') then 200 end as integer) as status,
  case when outcome in ('resolved', 'unchecked') then concat_ws(chr(10), 'content-type: text/html', 'date: ' || later,
    'etag: ' || case when tag = '"old"' then tag when tag is not null then 'W/' || tag else stag end, 'expires: ' || (later + 60),
    'last-modified: ' || coalesce(modified, smodified)) end as headers,
  case when outcome in ('resolved', 'unchecked') then md5(html) end as body_md5,
  cast(case when outcome in ('resolved', 'unchecked') then length(html) end as bigint) as body_chars
from o
"""
