"""WARC: not-modified revisits resolved to the response they stand for.

A revisit (304) names a URL and validators but carries no payload.  An as-of
join by canonical URL finds the latest earlier full response, the validators
decide whether it is the one, and the headers a 304 may change are merged
into the stored ones.  Payloads stay where they are; only digests travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm.asof import latest_before
from slotwise.llm.common import table

# Headers that a not-modified response may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query parameters that do not name a resource.
TRACKING = r"(utm_[a-z]+|ref|gclid|fbclid|sessionid)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without scheme, ``www.`` or default port; path without a
    trailing slash; query without tracking parameters, sorted; no fragment."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(u, r"^([^/?]*)", 1)), r"^www\.", ""),
                            r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(u, r"\?(.*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^" + TRACKING + "(=|$)"))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def header_map(block: Column) -> Column:
    """Header lines ``Name: value`` as a map with lower-case names; of repeated names the first."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), r"\r?\n"), lambda x: x.rlike(r"^[A-Za-z0-9-]+:"))
    pairs = F.transform(lines, lambda x: F.struct(
        F.lower(F.regexp_extract(x, r"^([^:]+):", 1)).alias("k"), F.trim(F.regexp_extract(x, r"^[^:]+:(.*)$", 1)).alias("v")))
    names = F.transform(pairs, lambda p: p["k"])
    first = F.filter(pairs, lambda p, i: F.array_position(names, p["k"]) == i + 1)
    return F.map_from_entries(first)


def header_lines(m: Column) -> Column:
    """A header map as ``name: value`` lines in the order of the names."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)),
                                    lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def resolve(responses: DataFrame, revisits: DataFrame) -> DataFrame:
    """One row per revisit: record_id, url (canonical), status, target_id, digest, headers.

    ``responses``: record_id, url, ts, block, digest; ``revisits``: record_id,
    url, ts, block (header lines as text).  The target is the latest response
    of the same canonical URL with a strictly earlier time (ties: the largest
    record_id).  Status:

    * ``resolved``: entity tags equal (weak comparison), or, if either side
      has none, the Last-Modified dates; only then target, digest and merged
      headers are given;
    * ``validator mismatch``; ``no validator`` (none that both sides have);
    * ``no response`` (none earlier; also a null URL or time).

    Repeated revisits are each resolved; other columns are ignored.  A hot URL
    is split by time like all others.
    """
    none = F.lit(None)

    def event(df: DataFrame, kind: int, digest: Column) -> DataFrame:
        return df.select("record_id", canonical_url(F.col("url")).alias("url"),
                         F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), F.lit(kind).alias("kind"),
                         F.col("block"), digest.alias("digest"))

    r = event(responses, 1, F.col("digest")).filter(F.col("url").isNotNull() & F.col("t").isNotNull())
    v = event(revisits, 0, none.cast("string"))
    known = v.filter(F.col("url").isNotNull() & F.col("t").isNotNull())
    stored = F.when(F.col("kind") == 1, F.struct("record_id", "block", "digest"))
    found = (latest_before(r.unionByName(known), "url", ["t", "kind", "record_id"], stored, "target").filter(F.col("kind") == 0)
                 .select("record_id", "url", "block", "target"))
    lost = v.filter(F.col("url").isNull() | F.col("t").isNull()).select(
        "record_id", "url", "block", none.cast(found.schema["target"].dataType).alias("target"))
    both = (found.unionByName(lost).withColumn("own", header_map(F.col("block")))
                 .withColumn("old", header_map(F.col("target.block"))))
    tag = lambda m: F.regexp_replace(F.get(F.array(m["etag"]), F.lit(0)), "^W/", "")
    by_tag = tag(F.col("own")) == tag(F.col("old"))
    by_date = F.col("own")["last-modified"] == F.col("old")["last-modified"]
    same = F.coalesce(by_tag, by_date)
    ok = F.col("target").isNotNull() & F.coalesce(same, F.lit(False))
    status = (F.when(F.col("target").isNull(), "no response").when(same.isNull(), "no validator")
               .when(same, "resolved").otherwise("validator mismatch"))
    new = F.map_filter(F.col("own"), lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(F.col("old"), lambda k, _: ~F.map_contains_key(new, k))
    return both.select("record_id", "url", status.alias("status"), F.when(ok, F.col("target.record_id")).alias("target_id"),
                       F.when(ok, F.col("target.digest")).alias("digest"),
                       F.when(ok, header_lines(F.map_concat(kept, new))).alias("headers"))


def records(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A crawl of ``pages``: a full response (2 * page_id) and a revisit (2 * page_id + 1) of every page.

    A page's revisit comes up to 500 minutes before or 1,500 minutes after its
    response.  Its validators are, by page, the entity tag, its weak form,
    another tag, the date only, or none.
    """
    p = F.col("page_id")
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    after = lambda minutes: base + F.make_dt_interval(mins=minutes.cast("int"))
    digest = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    date = F.concat(F.lit("day "), F.pmod(p, F.lit(97)).cast("string"))
    line = lambda name, value: F.concat(F.lit(name + ": "), value)
    response = F.concat_ws(
        "\r\n", F.lit("HTTP/1.1 200 OK"), line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.octet_length(F.coalesce("html", F.lit(""))).cast("string")), line("ETag", tag),
        line("Last-Modified", date), line("Cache-Control", F.lit("max-age=60")), line("Server", F.lit("origin")))
    how = F.pmod(p, F.lit(11))
    tags = (F.when(how == 3, F.concat(F.lit("W/"), tag)).when(how == 5, F.lit('"other"'))
             .when(how.isin(7, 8), F.lit(None)).otherwise(tag))
    dates = F.when(how == 7, date).when(how == 8, F.lit(None)).otherwise(date)
    revisit = F.concat_ws(
        "\r\n", F.lit("HTTP/1.1 304 Not Modified"), F.when(tags.isNotNull(), line("ETag", tags)),
        F.when(dates.isNotNull(), line("Last-Modified", dates)), line("Cache-Control", F.concat(F.lit("max-age="), p.cast("string"))),
        line("Date", F.concat(F.lit("minute "), p.cast("string"))), line("Server", F.lit("edge")),
        line("Content-Length", F.lit("0")))
    minutes = F.pmod(p, F.lit(1_000_000))
    return (pages.select((p * 2).alias("record_id"), "url", after(minutes).alias("ts"), response.alias("block"),
                         digest.alias("digest")),
            pages.select((p * 2 + 1).alias("record_id"), "url", after(minutes + F.pmod(p * 37, F.lit(2000)) - 500).alias("ts"),
                         revisit.alias("block")))


def op7_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revisit of the crawl of ``pages``, resolved."""
    return resolve(*records(table(spark, sf_dir, "pages")))


SQL = r"""
WITH p AS (
  SELECT page_id, md5(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS bytes,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u
  FROM pages
), q AS (
  SELECT *, array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
                lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid|sessionid)(=|$)'))), '&') AS query
  FROM p
), c AS (
  SELECT page_id, digest, bytes, '"' || substr(digest, 1, 16) || '"' AS tag, 'day ' || (page_id % 97) AS date,
         regexp_replace(regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '')
           || regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '')
           || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url,
         page_id % 1000000 AS t, page_id % 1000000 + (page_id * 37) % 2000 - 500 AS rt
  FROM q
), j AS (
  SELECT v.page_id, v.url, v.tag, v.date, r.page_id AS rp, r.digest AS rdigest, r.tag AS rtag, r.date AS rdate, r.bytes AS rbytes,
         row_number() OVER (PARTITION BY v.page_id ORDER BY r.t DESC, r.page_id DESC) AS n
  FROM c v LEFT JOIN c r ON v.url = r.url AND r.t < v.rt
), s AS (
  SELECT *, CASE WHEN rp IS NULL THEN 'no response' WHEN page_id % 11 = 8 THEN 'no validator'
                 WHEN page_id % 11 = 5 THEN 'validator mismatch'
                 WHEN page_id % 11 = 7 THEN CASE WHEN date = rdate THEN 'resolved' ELSE 'validator mismatch' END
                 WHEN tag = rtag THEN 'resolved' ELSE 'validator mismatch' END AS status
  FROM j WHERE n = 1
)
SELECT page_id * 2 + 1 AS record_id, url, status,
       CASE WHEN status = 'resolved' THEN rp * 2 END AS target_id,
       CASE WHEN status = 'resolved' THEN rdigest END AS digest,
       CASE WHEN status = 'resolved' THEN 'cache-control: max-age=' || page_id || chr(10) || 'content-length: ' || rbytes || chr(10)
         || 'content-type: text/html' || chr(10) || 'date: minute ' || page_id || chr(10)
         || 'etag: ' || CASE WHEN page_id % 11 = 3 THEN 'W/' || tag WHEN page_id % 11 = 7 THEN rtag ELSE tag END || chr(10)
         || 'last-modified: ' || rdate || chr(10) || 'server: origin' END AS headers
FROM s
"""
