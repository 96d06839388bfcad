"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark plans: straightforward SQL over the same
Parquet tables (views ``documents``, ``benchmark``, ``labels``, ``pages``).
The similarity join here is the plain inverted index (count shared grams per
pair), which DuckDB runs fast at the oracle's scale.
"""

from __future__ import annotations

from corpuscheck.functions.text import DEFAULT_STOP_WORDS
from corpuscheck.plans.registry import MISSING_BYTES, STORED_WORDS

# RE2 spelling of the White_Space class used by the Spark side.
_WS = r"\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _sig(col: str, stops=DEFAULT_STOP_WORDS) -> str:
    return (f"list_filter(string_split_regex(regexp_replace(lower(translate({col}, 'İΣ', 'iσ')), "
            rf"'\p{{P}}', ' ', 'g'), '[{_WS}]+'), "
            f"lambda x: x <> '' AND NOT list_contains({_sql_list(stops)}, x))")


def _tokens(col: str) -> str:
    return f"list_filter(string_split_regex({col}, '[{_WS}]+'), lambda x: x <> '')"


def _ngrams(w: str, n: int) -> str:
    return (f"list_transform(range(1, len({w}) - {n} + 2), "
            f"lambda i: array_to_string({w}[i:i + {n} - 1], ' '))")


def _paragraphs(col: str) -> str:
    return (f"CAST(len(list_filter(string_split({col}, chr(10) || chr(10)), "
            f"lambda p: regexp_matches(p, '[^{_WS}]'))) AS INTEGER)")


def _words(col: str) -> str:
    return f"CAST(len(regexp_extract_all({col}, '[^{_WS}]+')) AS INTEGER)"


def _bytes(col: str) -> str:
    return f"CAST(strlen({col}) AS INTEGER)"


UPLOADS = ("up AS (SELECT doc_id AS upload_id, printf('%s-%d.txt', source, doc_id) AS name, text, "
           f"sha256(text) AS content_hash, {_bytes('text')} AS n_bytes FROM documents)")

CATALOG = ("cat AS MATERIALIZED (SELECT min(upload_id) AS file_id, arg_min(name, upload_id) AS name, "
           "content_hash, CAST(min(upload_id) AS VARCHAR) AS location, "
           "arg_min(n_bytes, upload_id) AS n_bytes, arg_min(text, upload_id) AS text "
           "FROM up GROUP BY content_hash)")


def _gram_ctes(src: str, id_col: str, prefix: str, n: int) -> str:
    """``{p}g (id, norm_hash, grams)``, ``{p}gn (id, norm_hash, n)``, ``{p}tok (id, gram)``."""
    p = prefix
    return (f"{p}w AS MATERIALIZED (SELECT {id_col} AS id, {_sig('text')} AS w FROM {src}), "
            f"{p}g AS MATERIALIZED (SELECT id, sha256(array_to_string(w, ' ')) AS norm_hash, "
            f"list_distinct({_ngrams('w', n)}) AS grams FROM {p}w), "
            f"{p}gn AS (SELECT id, norm_hash, len(grams) AS n FROM {p}g), "
            f"{p}tok AS (SELECT id, unnest(grams) AS gram FROM {p}g)")


def _self_pairs(p: str, t: float) -> str:
    """``{p}pairs (a, b, exact, jaccard)`` with a < b."""
    return (f"{p}inter AS (SELECT x.id AS a, y.id AS b, count(*) AS i FROM {p}tok x JOIN {p}tok y "
            f"ON x.gram = y.gram AND x.id < y.id GROUP BY ALL), "
            f"{p}exact AS (SELECT x.id AS a, y.id AS b, x.n AS n FROM {p}gn x JOIN {p}gn y "
            f"ON x.norm_hash = y.norm_hash AND x.id < y.id), "
            f"{p}near AS (SELECT q.a, q.b, CAST(q.i AS DOUBLE) / (x.n + y.n - q.i) AS jaccard "
            f"FROM {p}inter q JOIN {p}gn x ON x.id = q.a JOIN {p}gn y ON y.id = q.b "
            f"WHERE x.norm_hash <> y.norm_hash), "
            f"{p}pairs AS (SELECT a, b, true AS exact, CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS jaccard "
            f"FROM {p}exact UNION ALL SELECT a, b, false AS exact, jaccard FROM {p}near "
            f"WHERE jaccard >= {t!r}::DOUBLE)")


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


STATS = (f"stats AS (SELECT file_id, {_paragraphs('text')} AS paragraph_count, "
         f"{_words('text')} AS word_count, n_bytes AS character_count FROM cat)")

LISTS = ("lists AS (SELECT b AS file_id, string_agg(CAST(a AS VARCHAR), ',' ORDER BY a) AS ids "
         "FROM pairs GROUP BY b)")

REPORT_CTES = (UPLOADS, CATALOG, _gram_ctes("cat", "file_id", "", 3), _self_pairs("", 0.3), STATS, LISTS)

REPORT_ROWS = ("report AS (SELECT s.file_id, s.paragraph_count, s.word_count, s.character_count, "
               "(l.ids IS NOT NULL) AS is_plagiarism, coalesce(l.ids, '') AS similar_file_ids, "
               "'' AS word_cloud_location FROM stats s LEFT JOIN lists l USING (file_id))")

REPORT_SQL = _with(*REPORT_CTES, REPORT_ROWS) + "SELECT * FROM report"

MIXED = ("mixed AS (SELECT 'documents' AS origin, doc_id AS upload_id, "
         "printf('%s-%d.txt', source, doc_id) AS name, text FROM documents "
         "UNION ALL SELECT 'pages' AS origin, page_id AS upload_id, printf('page-%d.html', page_id) AS name, "
         "html AS text FROM pages)")

MIDPOINT = "(SELECT (min(doc_id) + max(doc_id)) // 2 FROM documents)"

ORACLE_SQL: dict[str, str] = {
    "ingest_text": _with(MIXED) + (
        f"SELECT origin, upload_id, name, {_bytes('text')} AS n_bytes FROM mixed "
        "WHERE text IS NOT NULL AND name LIKE '%.txt'"),
    "rejected_uploads": _with(MIXED) + (
        "SELECT origin, upload_id, name, CASE WHEN text IS NULL THEN 'no content' "
        "ELSE 'name does not end in .txt' END AS reason FROM mixed "
        "WHERE text IS NULL OR name IS NULL OR name NOT LIKE '%.txt'"),
    "content_fingerprint": _with(UPLOADS) + "SELECT upload_id, name, content_hash FROM up",
    "upload_mapping": _with(UPLOADS) + (
        "SELECT upload_id, min(upload_id) OVER (PARTITION BY content_hash) AS file_id FROM up"),
    "file_catalog": _with(UPLOADS, CATALOG) + "SELECT file_id, name, content_hash, location, n_bytes FROM cat",
    "incremental_ingest": _with(UPLOADS) + (
        f"SELECT b.upload_id, coalesce(s.known_id, f.batch_id) AS file_id, "
        f"s.known_id IS NOT NULL AS already_stored, s.known_id IS NULL AS new_file "
        f"FROM (SELECT * FROM up WHERE upload_id >= {MIDPOINT}) b "
        f"JOIN (SELECT content_hash, min(upload_id) AS batch_id FROM up WHERE upload_id >= {MIDPOINT} "
        f"GROUP BY content_hash) f USING (content_hash) "
        f"LEFT JOIN (SELECT content_hash, min(upload_id) AS known_id FROM up WHERE upload_id < {MIDPOINT} "
        f"GROUP BY content_hash) s USING (content_hash)"),
    "hash_lookup": _with(UPLOADS, CATALOG) + (
        "SELECT p.kind, p.probe_id, p.content_hash, c.file_id FROM ("
        "SELECT 'benchmark' AS kind, item_id AS probe_id, sha256(text) AS content_hash FROM benchmark "
        "UNION ALL SELECT 'documents' AS kind, doc_id AS probe_id, sha256(text) AS content_hash FROM documents"
        ") p LEFT JOIN cat c ON c.content_hash = p.content_hash"),
    "file_lookup": _with(UPLOADS, CATALOG) + (
        "SELECT l.doc_id AS file_id, c.name, c.text, c.file_id IS NOT NULL AS found, "
        "CASE WHEN c.file_id IS NULL THEN 'unknown file id ' || CAST(l.doc_id AS VARCHAR) END AS error "
        "FROM labels l LEFT JOIN cat c ON c.file_id = l.doc_id"),
    "paragraph_count": f"SELECT doc_id, {_paragraphs('text')} AS paragraph_count FROM documents",
    "word_count": f"SELECT doc_id, {_words('text')} AS word_count FROM documents",
    "character_count": f"SELECT doc_id, {_bytes('text')} AS character_count FROM documents",
    "doc_stats": (f"SELECT doc_id, {_paragraphs('text')} AS paragraph_count, {_words('text')} AS word_count, "
                  f"{_bytes('text')} AS character_count FROM documents"),
    "tokens": (f"SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS word "
               f"FROM (SELECT doc_id, {_tokens('text')} AS w FROM documents)"),
    "significant_words": (f"SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, "
                          f"unnest(w) AS word FROM (SELECT doc_id, {_sig('text')} AS w FROM documents)"),
    "stop_word_filter": (
        f"SELECT doc_id, array_to_string("
        f"{_sig('text', [w for w in DEFAULT_STOP_WORDS if w != 'this'])}, ' ') AS normalized_text "
        f"FROM documents"),
    "ngrams": (f"WITH w AS MATERIALIZED (SELECT doc_id, {_tokens('text')} AS w FROM documents), "
               f"g AS (SELECT doc_id, {_ngrams('w', 3)} AS g FROM w) "
               f"SELECT doc_id, CAST(generate_subscripts(g, 1) - 1 AS INTEGER) AS pos, unnest(g) AS ngram FROM g"),
    "whitespace_collapsed": (r"SELECT doc_id, regexp_replace(text, '[\t\n\f\r ]+', ' ', 'g') AS collapsed "
                             "FROM documents"),
    "normalized_text": f"SELECT doc_id, array_to_string({_sig('text')}, ' ') AS normalized_text FROM documents",
    "ngram_frequency": _with(UPLOADS, CATALOG) + (
        f"SELECT file_id, ngram, CAST(count(*) AS INTEGER) AS freq FROM ("
        f"SELECT file_id, unnest({_ngrams('w', 3)}) AS ngram FROM ("
        f"SELECT file_id, {_sig('text')} AS w FROM cat)) GROUP BY ALL"),
    "word_frequencies": (
        f"WITH c AS (SELECT doc_id, word, count(*) AS value FROM ("
        f"SELECT doc_id, unnest({_sig('text')}) AS word FROM documents) GROUP BY ALL), "
        f"r AS (SELECT doc_id, word, value, row_number() OVER (PARTITION BY doc_id ORDER BY value DESC, word ASC) "
        f"AS rank FROM c) SELECT doc_id, CAST(rank AS INTEGER) AS rank, word AS text, "
        f"CAST(value AS INTEGER) AS value FROM r"),
    "unique_words": f"SELECT doc_id, CAST(len(list_distinct({_sig('text')})) AS INTEGER) AS unique_words FROM documents",
    "normalized_hash": _with(UPLOADS, CATALOG, _gram_ctes("cat", "file_id", "", 3)) + (
        "SELECT id AS file_id, norm_hash FROM g"),
    "exact_duplicates": (
        "WITH both_editions AS (SELECT doc_id * 2 AS id, text FROM documents UNION ALL "
        "SELECT doc_id * 2 + 1 AS id, '(' || translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') "
        f"|| ')!' AS text FROM documents), h AS MATERIALIZED (SELECT id, sha256(array_to_string({_sig('text')}, ' ')) AS norm_hash "
        "FROM both_editions) SELECT x.id AS file_id_a, y.id AS file_id_b FROM h x JOIN h y "
        "ON x.norm_hash = y.norm_hash AND x.id < y.id"),
    "pair_jaccard": _with(UPLOADS, CATALOG, _gram_ctes("cat", "file_id", "", 3)) + (
        "SELECT x.id AS file_id_a, y.id AS file_id_b, "
        "CASE WHEN len(x.grams) + len(y.grams) - len(list_intersect(x.grams, y.grams)) = 0 THEN 0.0::DOUBLE "
        "ELSE CAST(len(list_intersect(x.grams, y.grams)) AS DOUBLE) / "
        "(len(x.grams) + len(y.grams) - len(list_intersect(x.grams, y.grams))) END AS jaccard "
        "FROM g x JOIN g y ON y.id = x.id + 1"),
    "similar_pairs": _with(UPLOADS, CATALOG, _gram_ctes("cat", "file_id", "", 3), _self_pairs("", 0.3)) + (
        "SELECT a AS file_id_a, b AS file_id_b, exact, jaccard FROM pairs"),
    "tunable_similarity": _with(UPLOADS, CATALOG, _gram_ctes("cat", "file_id", "", 2), _self_pairs("", 0.2)) + (
        "SELECT a AS file_id_a, b AS file_id_b, exact, jaccard FROM pairs"),
    "prior_similar": _with(UPLOADS, CATALOG, _gram_ctes("cat", "file_id", "", 3), _self_pairs("", 0.3)) + (
        "SELECT b AS file_id, a AS similar_file_id FROM pairs"),
    "plagiarism_verdict": _with(*REPORT_CTES) + (
        "SELECT s.file_id, (l.ids IS NOT NULL) AS is_plagiarism, coalesce(l.ids, '') AS similar_file_ids "
        "FROM stats s LEFT JOIN lists l USING (file_id)"),
    "check_against_corpus": _with(
        UPLOADS, CATALOG, _gram_ctes("cat", "file_id", "", 3), _gram_ctes("benchmark", "item_id", "p", 3),
        "pinter AS (SELECT x.id AS probe, y.id AS doc, count(*) AS i FROM ptok x JOIN tok y "
        "ON x.gram = y.gram GROUP BY ALL)",
        "pexact AS (SELECT x.id AS probe, y.id AS doc FROM pgn x JOIN gn y ON x.norm_hash = y.norm_hash)",
        "pnear AS (SELECT q.probe, q.doc FROM pinter q JOIN pgn x ON x.id = q.probe JOIN gn y ON y.id = q.doc "
        "WHERE x.norm_hash <> y.norm_hash AND CAST(q.i AS DOUBLE) / (x.n + y.n - q.i) >= 0.3::DOUBLE)",
        "pe AS (SELECT probe, doc FROM pexact UNION ALL SELECT probe, doc FROM pnear)") + (
        "SELECT b.item_id AS probe_id, count(pe.doc) > 0 AS is_plagiarism, "
        "coalesce(string_agg(CAST(pe.doc AS VARCHAR), ',' ORDER BY pe.doc), '') AS similar_file_ids "
        "FROM benchmark b LEFT JOIN pe ON pe.probe = b.item_id GROUP BY b.item_id"),
    "upsert_results": _with(*REPORT_CTES, REPORT_ROWS) + (
        f"SELECT file_id, paragraph_count, CASE WHEN file_id >= {MIDPOINT} THEN word_count "
        f"ELSE word_count + {STORED_WORDS} END AS word_count, character_count, "
        f"CASE WHEN file_id >= {MIDPOINT} THEN is_plagiarism ELSE NOT is_plagiarism END AS is_plagiarism, "
        "word_cloud_location FROM report"),
    "insert_ignore_similar": _with(UPLOADS, CATALOG, _gram_ctes("cat", "file_id", "", 3), _self_pairs("", 0.3)) + (
        "SELECT b AS file_id, a AS similar_file_id FROM pairs UNION ALL SELECT a, b FROM pairs"),
    "result_lookup": _with(*REPORT_CTES, REPORT_ROWS) + (
        "SELECT d.doc_id AS file_id, r.paragraph_count, r.word_count, r.character_count, r.is_plagiarism, "
        "r.word_cloud_location, r.file_id IS NOT NULL AS found, "
        "CASE WHEN r.file_id IS NULL THEN 'no stored result for file ' || CAST(d.doc_id AS VARCHAR) "
        "END AS error FROM documents d LEFT JOIN report r ON r.file_id = d.doc_id"),
    "similar_lookup": _with(*REPORT_CTES) + (
        "SELECT c.file_id, coalesce(l.ids, '') AS similar_file_ids FROM cat c LEFT JOIN lists l USING (file_id)"),
    "analyzed_ids": _with(UPLOADS, CATALOG) + "SELECT file_id FROM cat",
    "document_report": REPORT_SQL,
    "incremental_report": _with(*REPORT_CTES, REPORT_ROWS) + (
        f"SELECT * REPLACE (CASE WHEN file_id < {MIDPOINT} THEN word_count + {STORED_WORDS} ELSE word_count END AS word_count) "
        "FROM report"),
    "stream_report": REPORT_SQL,
    "missing_content_tolerant": _with(
        UPLOADS, CATALOG.replace("cat AS MATERIALIZED", "every_file AS MATERIALIZED"),
        f"cat AS MATERIALIZED (SELECT * FROM every_file WHERE n_bytes % {MISSING_BYTES} <> 0)",
        *REPORT_CTES[2:], REPORT_ROWS) + (
        "SELECT q.file_id, CASE WHEN r.file_id IS NULL THEN 'error' ELSE 'ok' END AS status, "
        "CASE WHEN e.file_id IS NULL THEN 'unknown file id ' || CAST(q.file_id AS VARCHAR) "
        "WHEN r.file_id IS NULL THEN 'content is missing' END AS error, "
        "r.paragraph_count, r.word_count, r.character_count, r.is_plagiarism, r.similar_file_ids "
        "FROM (SELECT DISTINCT doc_id AS file_id FROM labels) q LEFT JOIN every_file e ON e.file_id = q.file_id "
        "LEFT JOIN report r ON r.file_id = q.file_id"),
}
