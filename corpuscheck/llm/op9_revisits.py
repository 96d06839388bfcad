"""WARC: resolution of not-modified revisits.

``resolve`` takes archive records ``(record_id, url, ts, kind, headers,
payload)``; ``kind`` is ``response`` (full) or ``revisit`` (not modified, no
payload). A revisit is joined as of its time to the latest earlier full
response with the same canonical URL. Its validators are checked (``etag``,
else ``last-modified``, else ``digest``, the first that both sides have), and
headers that a 304 answer may update are merged over the stored ones.

The as-of join never sorts all captures of one URL in one task: a timeline is
cut into slices of ``ts``, the last response is carried inside a slice by a
window and across slices by one row for each slice. Only ids and validators
take part; the payload is fetched once, by the source's id, and the ids wanted
are written first, so that their known size decides between a broadcast and a
shuffle.

Defined results: a revisit without an earlier response, or with a NULL or
malformed URL, is ``unresolved``; different validators give ``mismatch``;
either keeps its own headers and no payload; responses are ``full``; none of
the shared validators counts as ``unchecked`` and resolves; equal times are
ordered by record id, and a NULL time stands before all others; repeated
records (equal id) resolve alike; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscheck.llm import urls
from corpuscheck.session import materialize

# Headers that a not-modified answer may update; those that
# describe the stored payload stay as they were.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning")
VALIDATORS = ("etag", "last-modified", "digest")

#: Captures of one slice of the timeline, if captures are even over time.
SLICE_ROWS = 4096


def latest_before(events: DataFrame, value: Column, when: Column, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``events`` (with ``key``, ``ts``, ``record_id``) and ``source``: ``value`` of the latest earlier event of the key for which ``when`` holds."""
    # the slice's width follows the time span and the number of events
    span = events.agg(F.min("ts"), F.max("ts"), F.count(F.lit(1))).first()
    width = max(1, -(-((span[1] or 0) - (span[0] or 0) + 1) // max(1, -(-(span[2] or 0) // slice_rows))))
    cut = events.withColumn("slice", F.coalesce(F.floor(F.col("ts") / F.lit(width)), F.lit(-(1 << 62))))
    inside = Window.partitionBy("key", "slice").orderBy("ts", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    own = cut.withColumn("inside", F.last(F.when(when, value), ignorenulls=True).over(inside))
    ends = (cut.filter(when).groupBy("key", "slice")
            .agg(F.max_by(value, F.struct("ts", "record_id")).alias("last")))
    slices = cut.select("key", "slice").distinct().join(ends, ["key", "slice"], "left")
    across = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select("key", "slice", F.last("last", ignorenulls=True).over(across).alias("carried")).filter("carried IS NOT NULL")
    return (own.join(carried, ["key", "slice"], "left").withColumn("source", F.coalesce("inside", "carried"))
            .drop("inside", "carried", "slice"))


def resolve(records: DataFrame) -> DataFrame:
    """Every record with ``canonical_url, status, source_id``, merged ``headers`` and its ``payload``."""
    records = records.select("record_id", "url", "ts", "kind", "headers", "payload", urls.canonical_key(F.col("url")).alias("key"))
    validators = F.struct(*[F.col("headers")[v].alias(v.replace("-", "_")) for v in VALIDATORS])
    slim = records.filter("key IS NOT NULL").select("key", "ts", "record_id", "kind", validators.alias("own"))
    found = latest_before(slim, F.struct(F.col("record_id").alias("id"), F.col("own").alias("of")), F.col("kind") == "response")
    checks = [F.when(F.col(f"own.{v}").isNotNull() & F.col(f"source.of.{v}").isNotNull(), F.col(f"own.{v}") == F.col(f"source.of.{v}"))
              for v in (x.replace("-", "_") for x in VALIDATORS)]
    agree = F.coalesce(*checks)
    status = (F.when(F.col("source").isNull(), "unresolved").when(agree.isNull(), "unchecked").when(agree, "resolved").otherwise("mismatch"))
    revisits = (found.filter("kind = 'revisit'").select("record_id", status.alias("status"), F.col("source.id").alias("source_id"))
                .dropDuplicates(["record_id"]))
    # written, so that the planner knows its size: while it is small, payloads needn't be shuffled to meet it
    revisits = materialize(revisits, "warc-revisits")
    stored = (records.filter("kind = 'response'").select(F.col("record_id").alias("source_id"), F.col("headers").alias("stored_headers"),
                                                         F.col("payload").alias("stored_payload")))
    used = revisits.filter("status IN ('resolved', 'unchecked')").select(F.col("source_id")).distinct()
    stored = stored.join(used, "source_id", "left_semi").dropDuplicates(["source_id"])
    again = (records.filter("kind = 'revisit'").join(revisits, "record_id", "left").join(stored, "source_id", "left"))
    usable = F.col("status").isin("resolved", "unchecked")
    update = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter("stored_headers", lambda k, _: ~F.map_contains_key(F.coalesce(update, F.create_map().cast("map<string,string>")), k))
    merged = F.when(usable, F.map_concat(kept, F.coalesce(update, F.create_map().cast("map<string,string>")))).otherwise(F.col("headers"))
    again = again.select("record_id", "url", "ts", "kind", F.col("key").alias("canonical_url"),
                         F.coalesce("status", F.lit("unresolved")).alias("status"), F.when(usable, F.col("source_id")).alias("source_id"),
                         merged.alias("headers"), F.when(usable, F.col("stored_payload")).alias("payload"))
    full = records.filter("kind IS NULL OR kind <> 'revisit'").select(
        "record_id", "url", "ts", "kind", F.col("key").alias("canonical_url"), F.lit("full").alias("status"),
        F.lit(None).cast(records.schema["record_id"].dataType).alias("source_id"), "headers", "payload")
    return full.unionAll(again)


# How revisits are derived from a page, as text that Spark and DuckDB read alike.
#: Distance of the ids of a page's records; page ids are smaller.
REVISIT_IDS = 1 << 40
_TURN = "(((page_id % 8) + 8) % 8)"
_ALIAS_TURN = "(((page_id % 3) + 3) % 3)"
#: The second revisit of a page is only of every third one.
_HELD = f"(n = 1 OR {_ALIAS_TURN} = 0)"
_ID = f"(page_id + n * CAST({REVISIT_IDS} AS BIGINT))"
#: Turn 7's first revisit is before the page's own capture, all others after it.
_TS = f"CASE WHEN n = 1 AND {_TURN} = 7 THEN page_id - 1 ELSE page_id + CAST(n * n * 10 AS BIGINT) END"
#: Turns 0 to 2 and 7 agree by etag, 3 by digest, 4 differs by etag, 5 by digest, 6 has no validator; second revisits agree by etag.
_ETAG = f"CASE WHEN n = 2 OR {_TURN} IN (0, 1, 2, 7) THEN substr(digest, 1, 16) WHEN {_TURN} = 4 THEN 'x' || substr(digest, 1, 15) END"
_DIGEST = f"CASE WHEN n = 1 AND {_TURN} = 3 THEN digest WHEN n = 1 AND {_TURN} = 5 THEN 'x' || digest END"
#: Other scheme, a tracking parameter, or a fragment.
_ALIAS = f"""CASE WHEN {_ALIAS_TURN} = 0 THEN CASE WHEN left(url, 7) = 'http://' THEN 'https://' || substr(url, 8)
    WHEN left(url, 8) = 'https://' THEN 'http://' || substr(url, 9) ELSE url END
  WHEN {_ALIAS_TURN} = 1 THEN split_part(url, '#', 1) || CASE WHEN contains(split_part(url, '#', 1), '?') THEN '&' ELSE '?' END || 'utm_source=archive'
  ELSE url || '#again' END"""


def _revisits(pages: DataFrame) -> DataFrame:
    """One or two not-modified records of every page (``record_id``, ``url``, ``digest``), under alias URLs."""
    each = (pages.select(F.col("record_id").alias("page_id"), "url", "digest", F.explode(F.array(F.lit(1), F.lit(2))).alias("n")).filter(_HELD)
            .select(F.expr(_ID).alias("record_id"), F.expr(_ALIAS).alias("url"), F.expr(_TS).alias("ts"), F.expr(_ETAG).alias("etag"), F.expr(_DIGEST).alias("digest")))
    headers = F.map_filter(F.create_map(F.lit("etag"), F.col("etag"), F.lit("digest"), F.col("digest"),
                                        F.lit("date"), F.concat(F.lit("t"), F.col("ts").cast("string")), F.lit("content-length"), F.lit("0")),
                           lambda _, v: v.isNotNull())
    return each.select("record_id", "url", "ts", F.lit("revisit").alias("kind"), headers.alias("headers"), F.lit(None).cast("string").alias("payload"))


def archive(pages: DataFrame) -> DataFrame:
    """Pages as a crawler would store them: a page whose canonical URL's previous
    capture had the same html becomes a not-modified revisit without payload.

    The page's id is its capture time. Every page is also revisited under an
    alias URL, every third one twice; the revisits' validators agree, differ or
    are absent by the page's id, and some are before the page's own capture.
    """
    pages = pages.select(F.col("page_id").cast("bigint").alias("record_id"), F.col("page_id").cast("bigint").alias("ts"),
                         F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    pages = pages.withColumn("digest", F.sha2(F.coalesce("html", F.lit("")), 256)).withColumn("key", urls.canonical_key(F.col("url")))
    # repeated rows of one page are one capture, not each other's earlier one
    once = pages.filter("key IS NOT NULL").groupBy("key", "ts", "record_id").agg(F.max("digest").alias("digest"))
    seen = latest_before(once, F.col("digest"), F.lit(True)).filter("source IS NOT NULL")
    same = materialize(seen.select("record_id", "key", F.col("source").alias("seen")), "warc-same")
    again = F.coalesce(F.col("seen") == F.col("digest"), F.lit(False))
    date = F.concat(F.lit("t"), F.col("ts").cast("string"))
    headers = F.when(again, F.create_map(F.lit("etag"), F.substring("digest", 1, 16), F.lit("date"), date, F.lit("content-length"), F.lit("0"))) \
        .otherwise(F.create_map(F.lit("etag"), F.substring("digest", 1, 16), F.lit("date"), date, F.lit("digest"), F.col("digest"),
                                F.lit("content-type"), F.lit("text/html"), F.lit("content-length"),
                                F.octet_length(F.coalesce("html", F.lit(""))).cast("string")))
    captures = pages.join(same, ["record_id", "key"], "left").select(
        "record_id", "url", "ts", F.when(again, "revisit").otherwise("response").alias("kind"), headers.alias("headers"),
        F.when(~again, F.coalesce("html", F.lit(""))).alias("payload"))
    return captures.unionAll(_revisits(pages))


def op9_revisits(spark, sf_dir: str) -> DataFrame:
    """Every page and its revisits, archived and resolved again; a revisit's id is its page's plus multiples of ``REVISIT_IDS``."""
    from corpuscheck.llm.tables import read

    return resolve(archive(read(spark, sf_dir, "pages"))).select(
        F.col("record_id").alias("page_id"), "canonical_url", "kind", "status", "source_id",
        F.sha2("payload", 256).alias("payload_sha256"), F.col("headers")["date"].alias("date"), F.col("headers")["etag"].alias("etag"),
        F.col("headers")["content-length"].alias("content_length"), F.col("headers")["content-type"].alias("content_type"))


SQL = f"""
WITH p AS MATERIALIZED (SELECT CAST(page_id AS BIGINT) AS page_id, url, {urls.sql_key('url')} AS key, coalesce(html, '') AS html,
  sha256(coalesce(html, '')) AS digest FROM pages),
once AS (SELECT key, page_id, lag(max(digest)) OVER (PARTITION BY key ORDER BY page_id) AS seen FROM p WHERE key IS NOT NULL GROUP BY key, page_id),
k AS (SELECT p.*, CASE WHEN seen = digest THEN 'revisit' ELSE 'response' END AS kind FROM p LEFT JOIN once USING (key, page_id)),
v AS (SELECT {_ID} AS id, {_TS} AS ts, {_ALIAS} AS url, {_ETAG} AS etag, {_DIGEST} AS validator FROM p CROSS JOIN (VALUES (1), (2)) AS t(n) WHERE {_HELD}),
r AS (SELECT page_id AS id, page_id AS ts, key, kind, digest[1:16] AS etag, CASE WHEN kind = 'response' THEN digest END AS validator, digest,
    CAST(strlen(html) AS VARCHAR) AS bytes FROM k
  UNION ALL SELECT id, ts, {urls.sql_key('url')}, 'revisit', etag, validator, NULL, NULL FROM v),
s AS (SELECT *, CASE WHEN key IS NOT NULL AND kind = 'revisit' THEN max(CASE WHEN kind = 'response' THEN id END)
  OVER (PARTITION BY key ORDER BY ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS source FROM r),
j AS (SELECT s.*, o.etag AS source_etag, o.digest AS source_digest, o.bytes AS source_bytes, CASE WHEN s.kind = 'response' THEN 'full'
  WHEN s.source IS NULL THEN 'unresolved' ELSE CASE coalesce(s.etag = o.etag, s.validator = o.validator)
  WHEN true THEN 'resolved' WHEN false THEN 'mismatch' ELSE 'unchecked' END END AS status
  FROM s LEFT JOIN (SELECT DISTINCT ON (id) * FROM r WHERE kind = 'response') o ON o.id = s.source)
SELECT id AS page_id, key AS canonical_url, kind, status, CASE WHEN status IN ('resolved', 'unchecked') THEN source END AS source_id,
  CASE WHEN status = 'full' THEN digest WHEN status IN ('resolved', 'unchecked') THEN source_digest END AS payload_sha256, 't' || ts AS date,
  CASE WHEN status = 'unchecked' OR (status = 'resolved' AND etag IS NULL) THEN source_etag ELSE etag END AS etag,
  CASE WHEN status = 'full' THEN bytes WHEN status IN ('resolved', 'unchecked') THEN source_bytes ELSE '0' END AS content_length,
  CASE WHEN status IN ('full', 'resolved', 'unchecked') THEN 'text/html' END AS content_type
FROM j
"""
