"""URL filters with redirect equivalence.

Rules are (action, host, path): a rule fits its host and all subdomains when
the URL's path starts with the rule's; the longest fitting rule decides. Pages
that no rule fits take part in redirect equivalence: canonical links and meta
refreshes are edges between canonical URL keys, components of that graph are
aliases of one resource (every such tag of a page counts, its attributes in any
order and case), and a block that a rule gave to any alias reaches the
undecided ones, unless a rule explicitly allows an alias.

All of it is DataFrame operations. Rules meet the distinct hosts (their
suffixes), not the pages; verdicts per key are pre-aggregated; components come
from the distributed algorithm in ``components``. The joins back to the pages
have one row for each key on the other side, so a host or URL that holds a
large share of all pages is a skewed join that AQE splits.

Defined results: a NULL URL or one without ``://`` has an empty host and path,
no rule and no aliases; a NULL html has no links; repeated rows are judged
alike; equally long rules: allow wins; an empty table gives an empty result;
other columns are ignored. Undecided and unlinked pages are allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscheck.llm import urls
from corpuscheck.llm.components import connected_components

# The rules of the registered query.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

# What a page may name another place by: every link and meta tag, its attributes in any order and case.
_NAMES = r"(?i)canonical|refresh"
_TAG = r"(?is)(<(?:link|meta)\b[^>]*>)"
_CANONICAL = r"(?is)^<link\b.*\brel\s*=\s*(?:\"[^\"]*\bcanonical\b|'[^']*\bcanonical\b|canonical\b)"
_HREF = r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"
_REFRESH = r"(?is)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"
_CONTENT = r"(?is)\bcontent\s*=\s*[\"']?\s*[0-9.]+\s*;\s*url\s*=\s*[\"']?\s*([^\"'\s>]+)"


def rule_table(spark, rules=RULES) -> DataFrame:
    """``(action, host, path)``; give any such table instead for long lists."""
    return spark.createDataFrame(list(rules), "action string, host string, path string")


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, rules)``: the rules that fit each distinct host, by its suffixes."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    each = hosts.filter("host <> ''").select("host", F.explode(suffixes).alias("suffix"))
    listed = rules.select(F.col("host").alias("suffix"), F.struct(
        F.length(F.concat("host", "path")).alias("size"), (F.col("action") == "allow").alias("allowed"),
        F.concat("host", "path").alias("rule"), F.col("path").alias("start"), F.col("action").alias("action")).alias("r"))
    return each.join(listed, "suffix").groupBy("host").agg(F.collect_set("r").alias("rules"))


def by_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``pages`` (with ``host`` and ``path``) and their longest rule and its action, or NULLs."""
    fitting = rules_of_hosts(pages.select("host").distinct(), rules)
    best = F.array_max(F.filter("rules", lambda r: F.col("path").startswith(r["start"])))
    return (pages.join(fitting, "host", "left").withColumn("best", best)
            .withColumn("rule", F.col("best.rule")).withColumn("action", F.col("best.action")).drop("rules", "best"))


def links(pages: DataFrame) -> DataFrame:
    """``(a, b)``: canonical keys of pages and of what they redirect or canonically link to."""
    html, url = F.col("html"), F.col("url")
    # the plain search spares almost every page the expressions
    named = pages.filter(url.contains("://") & html.rlike(_NAMES))
    target = lambda t: (F.when(t.rlike(_CANONICAL), F.regexp_extract(t, _HREF, 1))
                        .when(t.rlike(_REFRESH), F.regexp_extract(t, _CONTENT, 1)))
    tags = named.select(url, F.explode(F.regexp_extract_all(html, F.lit(_TAG), 1)).alias("tag"))
    found = tags.select(url, target(F.col("tag")).alias("t")).filter("t <> ''")
    return (found.select(urls.canonical_key(url).alias("a"), urls.canonical_key(urls.absolute(F.col("t"), url)).alias("b"))
            .filter("a <> b").distinct())


def decide(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every page."""
    pages = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    ruled = by_rules(pages.select("page_id", "url", urls.host(F.col("url")).alias("host"), urls.path(F.col("url")).alias("path"),
                                  urls.canonical_key(F.col("url")).alias("key")), rules)
    aliases = connected_components(links(pages))
    votes = (ruled.filter("key IS NOT NULL AND action IS NOT NULL").groupBy("key")
             .agg(F.max(F.col("action") == "block").alias("blocked"), F.max(F.col("action") == "allow").alias("allowed")))
    votes = votes.join(aliases, votes["key"] == aliases["node"], "left").withColumn("component", F.coalesce("component", "key"))
    blocked = (votes.groupBy("component").agg(F.max("blocked").alias("blocked"), F.max("allowed").alias("allowed"))
               .filter("blocked AND NOT allowed").select("component"))
    # the keys of blocked components: their linked aliases, and the components' own names
    keys = (blocked.join(aliases, "component").select(F.col("node").alias("key"))
            .unionAll(blocked.select(F.col("component").alias("key"))).distinct().withColumn("by_alias", F.lit(True)))
    verdict = F.when(F.col("action").isNotNull(), F.col("action")).when(F.col("by_alias"), F.lit("block")).otherwise(F.lit("allow"))
    return ruled.join(keys, "key", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    """Rule and verdict of every URL of ``pages``."""
    from corpuscheck.llm.tables import read

    return decide(read(spark, sf_dir, "pages"), rule_table(spark))


def _sql() -> str:
    rules = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in RULES)
    target = ("CASE WHEN t IS NULL OR t = '' THEN NULL WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t "
              "WHEN starts_with(t, '//') THEN 'http:' || t WHEN starts_with(t, '/') THEN 'http://' || host || t "
              "WHEN starts_with(t, '#') OR starts_with(t, '?') THEN 'http://' || host || path || t "
              "ELSE 'http://' || host || CASE WHEN contains(path, '/') THEN regexp_replace(path, '[^/]*$', '') ELSE '/' END || t END")
    q = lambda r: "$re$" + r + "$re$"
    return f"""
WITH RECURSIVE rules(action, rhost, rpath) AS (VALUES {rules}),
p AS MATERIALIZED (SELECT row_number() OVER () AS n, page_id, url, html, {urls.sql_host('url')} AS host, {urls.sql_path('url')} AS path,
  {urls.sql_key('url')} AS key FROM pages),
best AS (SELECT n, arg_max(rhost || rpath, (length(rhost || rpath), action = 'allow')) AS rule,
  arg_max(action, (length(rhost || rpath), action = 'allow')) AS action
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY n),
ruled AS MATERIALIZED (SELECT p.page_id, host, path, key, rule, action FROM p LEFT JOIN best USING (n)),
tags AS (SELECT key, host, path, unnest(regexp_extract_all(html, {q(_TAG)}, 1)) AS tag FROM p WHERE key IS NOT NULL),
found AS (SELECT key, host, path, CASE WHEN regexp_matches(tag, {q(_CANONICAL)}) THEN regexp_extract(tag, {q(_HREF)}, 1)
  WHEN regexp_matches(tag, {q(_REFRESH)}) THEN regexp_extract(tag, {q(_CONTENT)}, 1) END AS t FROM tags),
goals AS (SELECT key, {target} AS goal FROM found),
one AS (SELECT DISTINCT key AS a, {urls.sql_key('goal')} AS b FROM goals WHERE goal IS NOT NULL),
edges AS MATERIALIZED (SELECT a, b FROM one WHERE a <> b UNION SELECT b, a FROM one WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
comp AS (SELECT a AS key, min(b) AS component FROM reach GROUP BY a),
votes AS (SELECT coalesce(component, key) AS component, bool_or(action = 'block') AS blocked, bool_or(action = 'allow') AS allowed
  FROM ruled LEFT JOIN comp USING (key) WHERE key IS NOT NULL AND action IS NOT NULL GROUP BY 1),
bad AS (SELECT component FROM votes WHERE blocked AND NOT allowed)
SELECT page_id, host, path, rule, CASE WHEN action IS NOT NULL THEN action
  WHEN coalesce(component, key) IN (SELECT component FROM bad) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN comp USING (key)
"""


SQL = _sql()
