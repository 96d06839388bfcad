import itertools
import random

import duckdb
import pytest

from corpuscheck.llm import op5_urls as U
from corpuscheck.llm import op9_revisits as V

EXTRA = "page_id long, url string, html string, host string, rule string, key string, kind string, payload string, ts string"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e", "f") for r in rows], EXTRA)


def _link(url):
    return f'<head><LINK href="{url}" rel="canonical"></head>'


PAGES = [
    (1, "http://shop.com/de/a", "x"),                                     # blocked by a rule
    (2, "https://alias.net/1", _link("https://shop.com/de/a#frag")),       # alias of 1
    (3, "https://alias.net/2?utm_source=q", '<meta http-equiv="Refresh" content="0; url=/1">'),
    (4, "http://free.org/x", _link("http://alias.net/2/")),                # explicit allow in that component
    (5, "http://alone.net/", None),
    (6, "http://bad.example.org/es/", _link("//mirror.net:443/es")),        # blocked
    (7, "http://mirror.net/es/", "x"),                                     # alias of 6
    (8, None, "x"), (9, "no scheme", "x"), (10, "http://Q.COM/fr/de/", ""),
    (11, "http://x.example.org/en/12", "x"), (12, "http://example.org/en", _link("sub/page")), (13, "http://notexample.org/es/", "x"),
    (14, "http://h.com?x://y/z", "x"), (15, "http://org", "x"), (7, "http://mirror.net/es/", "x"),
]


def test_rules_aliases_and_precedence(spark):
    got = {r.page_id: r for r in U.decide(_pages(spark, PAGES), U.rule_table(spark)).collect()}
    assert {k: (r.rule, r.verdict) for k, r in got.items()} == {
        1: ("com/de/", "block"), 2: (None, "allow"), 3: (None, "allow"), 4: ("org/", "allow"), 5: (None, "allow"),
        6: ("example.org/es/", "block"), 7: (None, "block"), 8: (None, "allow"), 9: (None, "allow"), 10: ("com/fr/", "allow"),
        11: ("example.org/en/1", "block"), 12: ("org/", "allow"), 13: ("org/", "allow"), 14: (None, "allow"), 15: (None, "allow")}
    assert (got[10].host, got[10].path, got[14].host, got[14].path) == ("q.com", "/fr/de/", "h.com", "")
    assert (got[8].host, got[9].path) == ("", "")
    without = [p for p in PAGES if p[0] != 4]
    again = {r.page_id: r.verdict for r in U.decide(_pages(spark, without), U.rule_table(spark)).collect()}
    assert again[2] == again[3] == "block"
    assert U.decide(spark.createDataFrame([], EXTRA), U.rule_table(spark)).count() == 0


def _same(spark, sql, got, rows):
    import pyarrow as pa

    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": [r[0] for r in rows], "url": pa.array([r[1] for r in rows], pa.string()),
                                    "html": pa.array([r[2] for r in rows], pa.string())}))
    rel = con.sql(sql)
    names = rel.columns
    key = lambda t: tuple(map(str, t))
    assert sorted(rel.fetchall(), key=key) == sorted((tuple(r[n] for n in names) for r in got.collect()), key=key)


MORE_LINKS = [
    (1, "http://b.com/de/q", "x"),                                                                     # blocked by a rule
    (2, "http://d.net/1", "<meta content='0;url=http://b.com/de/q' http-equiv='refresh'>"),             # content first
    (3, "http://d.net/2", '<link rel="alternate CanonicaL" href=http://d.net/1>'),                      # spelling, list of rels
    (4, "http://d.net/3", '<meta name=x><LINK HREF="http://none.net/" REL=canonical><link rel=canonical href="/2">'),   # the second one
    (5, "http://d.net/4", "<p rel='canonical' href='/2'>refresh</p>"),                                  # no link at all
    (6, "http://e.net/", '<meta http-equiv=refresh content="5"><meta HTTP-EQUIV="REFRESH" content="0; URL=http://d.net/3">'),
    (7, "http://f.net/", '<link rel="canonical-url" href="http://q.net/">'),
]


def test_every_tag_in_any_order_is_an_edge(spark):
    got = {r.page_id: r.verdict for r in U.decide(_pages(spark, MORE_LINKS), U.rule_table(spark)).collect()}
    assert {k: v for k, v in got.items() if k != 7} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "block"}
    _same(spark, U.SQL, U.decide(_pages(spark, MORE_LINKS), U.rule_table(spark)), MORE_LINKS)


def test_sql_of_url_filter_agrees(spark):
    _same(spark, U.SQL, U.decide(_pages(spark, PAGES), U.rule_table(spark)), PAGES)
    _same(spark, U.SQL, U.decide(_pages(spark, PAGES[4:]), U.rule_table(spark)), PAGES[4:])


RECORDS = "record_id long, url string, ts long, kind string, headers map<string,string>, payload string, key string, status string"


def _brute(rows):
    import re

    def canonical(u):
        if u is None or "://" not in u:
            return None
        rest = u.split("://", 1)[1].split("#")[0]
        main, _, query = rest.partition("?")
        host, slash, path = main.partition("/")
        query = "&".join(p for p in query.split("&") if p and not re.match(r"^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$", p))
        return re.sub(r":(80|443)?$", "", host.lower()) + (slash + path).rstrip("/") + ("?" + query if query else "")

    out = {}
    for r in rows:
        i, u, ts, kind, headers, payload = r[:6]
        if kind != "revisit":
            out[i] = ("full", None, headers, payload)
            continue
        k = canonical(u)
        order = lambda x: ((-(1 << 70) if x[2] is None else x[2]), x[0])
        before = [x for x in rows if x[3] == "response" and k is not None and canonical(x[1]) == k and order(x) < order(r)]
        if not before:
            out[i] = ("unresolved", None, headers, None)
            continue
        src = max(before, key=order)
        shared = [v for v in V.VALIDATORS if (headers or {}).get(v) is not None and (src[4] or {}).get(v) is not None]
        if shared and headers[shared[0]] != src[4][shared[0]]:
            out[i] = ("mismatch", None, headers, None)
        else:
            merged = None if src[4] is None else src[4] | {h: v for h, v in (headers or {}).items() if h in V.PERMITTED}
            out[i] = ("resolved" if shared else "unchecked", src[0], merged, src[5])
    return out


@pytest.mark.parametrize("slice_rows", [3, 4096])
def test_resolution_equals_brute_force(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(V.latest_before, "__defaults__", (slice_rows,))
    rng = random.Random(slice_rows)
    urls = ["http://a.com/x", "https://A.com:443/x/#f", "http://a.com/x?utm_a=1", "http://a.com/x?p=1", "b.com", None, "http://hot.com/"]
    rows = []
    for i in range(150):
        url = rng.choice(urls + ["http://hot.com/"] * 6)
        kind = rng.choice(["response", "revisit", "revisit", "metadata"])
        headers = {h: f"{h}{rng.randrange(2)}" for h in ("etag", "digest", "date", "content-length", "content-type") if rng.random() < 0.7}
        ts = None if rng.random() < 0.05 else rng.randrange(-20, 60)
        rows.append((i, url, ts, kind, headers or None, f"payload {i}" if kind == "response" else None, "k", "s"))
    got = {r.record_id: (r.status, r.source_id, r.headers, r.payload) for r in V.resolve(spark.createDataFrame(rows, RECORDS)).collect()}
    assert got == _brute(rows)
    assert len({v[0] for v in got.values()}) == 5


def test_archive_round_trip(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["http://a.com/", "https://a.com", "http://b.com/x", None, "zzz"]), rng.choice(["A", "B", None])) for i in range(80)]
    pages = _pages(spark, rows)
    records = V.archive(pages)
    full = {r.record_id: r for r in V.resolve(records).collect()}
    assert {i: full[i].payload for i, _, _ in rows} == {i: h or "" for i, _, h in rows}
    assert sum(r.kind == "revisit" for r in full.values()) > 10
    got = V.resolve(records).selectExpr(
        "record_id AS page_id", "canonical_url", "kind", "status", "source_id", "sha2(payload, 256) AS payload_sha256", "headers['date'] AS date",
        "headers['etag'] AS etag", "headers['content-length'] AS content_length", "headers['content-type'] AS content_type")
    _same(spark, V.SQL, got, rows)
    assert V.resolve(V.archive(spark.createDataFrame([], EXTRA))).count() == 0
    assert list(itertools.islice(records.columns, 6)) == ["record_id", "url", "ts", "kind", "headers", "payload"]


def test_registered_query_has_every_status(spark, tmp_path):
    rows = [(i, f"http{'s' * (i % 2)}://h{i % 40}.com/p{i % 57}" + ("?a=1#x" if i % 5 == 0 else ""), f"<p>{i % 9}</p>") for i in range(160)]
    rows += [(200, None, "x"), (201, "none", None)]
    _pages(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    got = V.op9_revisits(spark, str(tmp_path))
    _same(spark, V.SQL, got, rows)
    out = {r.page_id: r for r in got.collect()}
    count = {s: sum(r.status == s for r in out.values()) for s in ("full", "resolved", "unchecked", "mismatch", "unresolved")}
    assert min(count.values()) > 10 and len(out) > 2 * len(rows)
    # by the stated rule: page 0 is alone at its URL until its revisits, under the other scheme
    one, two = out[V.REVISIT_IDS], out[2 * V.REVISIT_IDS]
    assert [(r.kind, r.status, r.source_id, r.date, r.payload_sha256) for r in (one, two)] == [
        ("revisit", "resolved", 0, "t10", out[0].payload_sha256), ("revisit", "resolved", 0, "t40", out[0].payload_sha256)]
    first = {n: out[n + V.REVISIT_IDS] for n in (3, 4, 5, 6, 7, 200)}
    assert {n: r.status for n, r in first.items()} == {3: "resolved", 4: "mismatch", 5: "mismatch", 6: "unchecked", 7: "unresolved", 200: "unresolved"}
    assert first[6].source_id == 6 and first[4].payload_sha256 is None and first[4].content_length == "0"


def test_repeated_pages_keep_their_payload(spark, tmp_path):
    """Copies of one row are one capture: each stays a response, and revisits find it."""
    rows = [(1, "http://a.com/", "A")] * 3 + [(9, "http://a.com", "A"), (9, "http://a.com", "A"), (17, "http://a.com", "B"), (2, "http://b.com/", "A")]
    _pages(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    got = V.op9_revisits(spark, str(tmp_path))
    _same(spark, V.SQL, got, rows)
    out = [(r.page_id, r.kind, r.status, r.source_id, r.payload_sha256 is not None) for r in got.collect() if r.page_id < 100]
    assert sorted(out, key=str) == sorted([(1, "response", "full", None, True)] * 3 + [(9, "revisit", "resolved", 1, True)] * 2
                                          + [(17, "response", "full", None, True), (2, "response", "full", None, True)], key=str)
