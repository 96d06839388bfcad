"""URL parts and canonical keys as column expressions, and the same in DuckDB SQL.

The canonical key of a URL has no scheme, fragment, default port, tracking
parameter or trailing slash; the host is lower-cased (A-Z). NULL and strings
without ``://`` have none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters that only say where a visitor came from.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; NULL without one."""
    return F.when(url.contains("://"), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1))


def host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def query(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"(?s)^[^?#]*\?([^#]*)", 1), F.lit(""))


def canonical_key(url: Column) -> Column:
    params = F.array_join(F.filter(F.split(query(url), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)), "&")
    bare = F.regexp_replace(host(url), r":(80|443)?$", "")
    trimmed = F.regexp_replace(path(url), r"/+$", "")
    return F.when(url.contains("://"), F.concat(bare, trimmed, F.when(params != "", F.concat(F.lit("?"), params)).otherwise(F.lit(""))))


def absolute(link: Column, url: Column) -> Column:
    """``link`` as found on the page ``url``, with host and scheme."""
    top = F.concat(F.lit("http://"), host(url))
    folder = F.regexp_replace(path(url), r"[^/]*$", "")
    return (F.when(link.isNull() | (F.trim(link) == ""), F.lit(None))
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.startswith("//"), F.concat(F.lit("http:"), link))
            .when(link.startswith("/"), F.concat(top, link))
            .when(link.startswith("#") | link.startswith("?"), F.concat(top, path(url), link))
            .otherwise(F.concat(top, F.when(folder == "", F.lit("/")).otherwise(folder), link)))


# --- the same for DuckDB ----------------------------------------------------

def sql_lower(c: str) -> str:
    return f"translate({c}, '{_UPPER}', '{_LOWER}')"


def sql_rest(url: str) -> str:
    return f"regexp_extract({url}, '(?s)^.*?://(.*)$', 1)"


def sql_host(url: str) -> str:
    return f"coalesce({sql_lower(f'regexp_extract({sql_rest(url)}, $re$(?s)^([^/?#]*)$re$, 1)')}, '')"


def sql_path(url: str) -> str:
    return f"coalesce(regexp_extract({sql_rest(url)}, $re$(?s)^[^/?#]*([^?#]*)$re$, 1), '')"


def sql_query(url: str) -> str:
    return rf"coalesce(regexp_extract({sql_rest(url)}, $re$(?s)^[^?#]*\?([^#]*)$re$, 1), '')"


def sql_key(url: str) -> str:
    params = (f"array_to_string(list_filter(string_split({sql_query(url)}, '&'), "
              f"lambda p: p <> '' AND NOT regexp_matches(p, $re${TRACKING}$re$)), '&')")
    return (f"CASE WHEN contains({url}, '://') THEN regexp_replace({sql_host(url)}, ':(80|443)?$', '') || "
            f"regexp_replace({sql_path(url)}, '/+$', '') || CASE WHEN {params} <> '' THEN '?' || {params} ELSE '' END END")
