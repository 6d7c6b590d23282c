"""The same results in plain SQL, for a second engine to check against.

The statements are written on their own terms (joins, windows, one statement
per query) and share nothing with the DataFrame code but the fixed values.
The dialect is DuckDB's.
"""

from __future__ import annotations

from html.entities import name2codepoint

from dockhand.functions.text import WHITESPACE, all_stop_words
from dockhand.functions.paths import ACCEPTED_EXTENSIONS

AS_OF = "TIMESTAMP '2024-03-01 00:00:00'"

# Views over the supplied tables, inlined as common table expressions.
VIEWS = {
    "files": """
        SELECT doc_id AS file_id,
               concat('/staging/', source, '/doc_', CAST(doc_id AS VARCHAR),
                      CASE doc_id % 5 WHEN 0 THEN '.HTML' WHEN 1 THEN '.bin' ELSE '.txt' END) AS path,
               text AS content, CAST(strlen(text) AS BIGINT) AS size, lang, source, doc_id % 60 AS age_days
        FROM documents""",
    "landing_names": """
        SELECT file_id, concat('/staging/', CASE lang WHEN 'fr' THEN '.' WHEN 'de' THEN '_' ELSE '' END,
                               regexp_extract(path, '([^/]*)$', 1)) AS path
        FROM files""",
    "faulty": """
        SELECT file_id, path, lang, source,
               CASE WHEN path LIKE '%.bin' AND lang = 'fr' THEN concat(' ', chr(10), chr(9), ' ')
                    WHEN path LIKE '%.bin' AND lang = 'de' THEN NULL ELSE content END AS content,
               CASE WHEN path LIKE '%.bin' AND lang = 'es' THEN 0 ELSE size END AS size
        FROM files""",
    "parts": """
        SELECT p_partkey AS PartID, concat('PN-', CAST(p_partkey AS VARCHAR)) AS PartNumber,
               p_name AS Nomenclature, CAST(p_size AS DECIMAL(10,2)) AS Mass, p_brand AS CreatedBy FROM part""",
    "bom": """
        SELECT l_orderkey AS ProductID, l_partkey AS PartID, CAST(l_quantity AS BIGINT) AS Quantity FROM lineitem""",
    "part_revisions": "SELECT DISTINCT l_partkey AS PartID, l_returnflag AS Revision FROM lineitem",
    "change_management": """
        SELECT p_partkey AS PartID, concat('change ', p_type) AS ChangeDescription FROM part WHERE p_size > 25""",
    "products": """
        SELECT o_orderkey AS ProductID, o_orderpriority AS ProductName,
               concat('{"color": "', o_orderpriority, '"}') AS Configuration FROM orders""",
    "part_components": """
        SELECT CAST(floor(p_partkey / 5) AS BIGINT) AS ParentPartID, p_partkey AS ChildPartID,
               CAST(1 + p_size % 3 AS BIGINT) AS Quantity FROM part WHERE p_partkey > 0""",
    "revision_effectivity": """
        SELECT PartID, Revision, UsedOn,
               lead(UsedOn) OVER (PARTITION BY PartID ORDER BY UsedOn, Revision) AS EffectiveToDate
        FROM (SELECT l_partkey AS PartID, l_returnflag AS Revision, CAST(min(l_shipdate) AS DATE) AS UsedOn
              FROM lineitem GROUP BY l_partkey, l_returnflag) x""",
    "log": """
        SELECT event_id, user_id AS FileID, ts,
               CASE event_type WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'Processing'
                               WHEN 'click' THEN 'Retried' ELSE 'Completed' END AS Status,
               CASE WHEN event_type IN ('view','purchase') THEN value END AS DurationSeconds,
               CASE WHEN event_type IN ('error','click') THEN concat('code ', props) END AS ErrorLog,
               concat('/staging/file_', CAST(user_id AS VARCHAR), '.txt') AS path
        FROM events""",
    "monitor": """
        SELECT FileID, Status, DurationSeconds, ErrorLog, ts AS ProcessedAt
        FROM (SELECT *, row_number() OVER (PARTITION BY FileID ORDER BY ts DESC, event_id DESC) AS rn FROM log) x
        WHERE rn = 1""",
    "runs": """
        SELECT * REPLACE (FileID * 100 + day(ts) AS FileID,
                          concat('/staging/file_', CAST(FileID * 100 + day(ts) AS VARCHAR), '.txt') AS path)
        FROM log""",
    "failures": """
        SELECT *, row_number() OVER (PARTITION BY FileID ORDER BY ts, event_id) AS attempt
        FROM runs WHERE Status IN ('Failed', 'Retried')""",
    "outcomes": """
        SELECT FileID,
               count(*) FILTER (WHERE Status <> 'Processing') AS tries,
               count(*) FILTER (WHERE Status IN ('Failed', 'Retried')) AS failures,
               (SELECT f.ErrorLog FROM runs f WHERE f.FileID = l.FileID AND f.Status IN ('Failed', 'Retried')
                ORDER BY f.ts DESC, f.event_id DESC LIMIT 1) AS last_error,
               CASE WHEN bool_or(Status = 'Completed') THEN 'success'
                    WHEN count(*) FILTER (WHERE Status IN ('Failed', 'Retried')) >= 3 THEN 'failed'
                    WHEN count(*) FILTER (WHERE Status IN ('Failed', 'Retried')) > 0 THEN 'retrying'
                    WHEN bool_or(Status = 'Processing') THEN 'processing' ELSE 'pending' END AS outcome
        FROM runs l GROUP BY FileID""",
    "samples": """
        SELECT sample_ts, n_processed, n_failed,
               CAST(sum(n_processed) OVER w AS BIGINT) AS files_processed,
               CAST(sum(n_failed) OVER w AS BIGINT) AS files_failed,
               lag(sample_ts) OVER (ORDER BY sample_ts) AS previous_ts
        FROM (SELECT time_bucket(INTERVAL 30 SECONDS, ts, TIMESTAMP '2000-01-01') + INTERVAL 30 SECONDS AS sample_ts,
                     count(*) FILTER (WHERE Status = 'Completed') AS n_processed,
                     count(*) FILTER (WHERE Status IN ('Failed', 'Retried')) AS n_failed
              FROM log WHERE Status <> 'Processing' GROUP BY 1) s
        WINDOW w AS (ORDER BY sample_ts ROWS UNBOUNDED PRECEDING)""",
    "words": r"""
        SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda x: x <> '')) AS term
        FROM documents""",
    "index": "SELECT term, doc_id, count(*) AS tf FROM words GROUP BY term, doc_id",
    "folds": r"""
        SELECT doc_id, lang, CASE WHEN substring(md5(text), 1, 1) < '8' THEN 0 ELSE 1 END AS fold,
               unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda x: x <> '')) AS word
        FROM documents""",
    "vocabulary": "SELECT fold, lang, word, count(*) AS n FROM folds GROUP BY fold, lang, word",
    "entries": """
        SELECT fold, lang, 'word' AS kind, word AS entry, n FROM vocabulary
        UNION ALL
        SELECT fold, lang, 'gram', substring(' ' || word || ' ', i, 3), n
        FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)""",
}


def _needs(names: str) -> str:
    """WITH clause of the named views, in the order given."""
    return "WITH " + ", ".join(f"{name} AS ({VIEWS[name]})" for name in names.split())


WS = f"[{WHITESPACE}]"
NOT_WS = f"[^{WHITESPACE}]"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^{WS}+|{WS}+$', '', 'g')"


def _words_of(text: str) -> str:
    return f"CAST(len(regexp_extract_all({text}, '{NOT_WS}+')) AS BIGINT)"


def _mask_a(text: str) -> str:
    for pattern, value in [
        (r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b", "XXXX-XXXX-XXXX-XXXX"),
        (r"\b\d{3}-\d{2}-\d{4}\b", "XXX-XX-XXXX"),
        (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "XXXX@XXXX.com"),
    ]:
        text = f"regexp_replace({text}, '{pattern}', '{value}', 'g')"
    return text


def _mask_b(text: str) -> str:
    for pattern, value in [
        (r"\b\d{3}-\d{2}-\d{4}\b", "[SSN]"),
        (r"\b\d{16}\b", "[CREDIT_CARD]"),
        (r"[\p{L}\p{N}_.-]*[\p{L}\p{N}_]@[\p{L}\p{N}_.-]+\.[\p{L}\p{N}_]{2,4}\b", "[EMAIL]"),
    ]:
        text = f"regexp_replace({text}, '{pattern}', '{value}', 'g')"
    return f"coalesce({text}, '')"


def _each_match(text: str, pattern: str, change: str) -> str:
    """Change every match; ``change`` is an expression over ``x[2]``."""
    return (
        f"array_to_string(list_transform(list_zip(regexp_split_to_array({text}, '{pattern}'), "
        f"regexp_extract_all({text}, '{pattern}')), lambda x: x[1] || coalesce({change}, '')), '')"
    )


# The log rules, one derived table per rule so that each result is named once.
_LOG_STEPS = [
    _each_match("line", r"\b(?:\d{1,3}\.){3}\d{1,3}\b", r"regexp_replace(x[2], '\d', 'x', 'g')"),
    _each_match("line", r"\b(?:[0-9a-fA-F]{2}:){5}[0-9a-fA-F]{2}\b", "regexp_replace(x[2], '[0-9a-fA-F]', 'x', 'g')"),
    r"regexp_replace(line, '(password=)\S*', '\1****', 'g')",
    _each_match(
        "line", r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,4}", r"regexp_replace(x[2], '@[^.]+\.', '@****.', 'g')"
    ),
    _each_match(
        "line",
        r"\+?\d{1,3}[-.\s]?\(?\d{1,4}?\)?[-.\s]?\d{1,4}[-.\s]?\d{1,4}",
        r"regexp_replace(x[2], '(\d{3})[-.\s]?(\d{3})[-.\s]?(\d{4})', '\1-***-****', 'g')",
    ),
    _each_match("line", r"\b(?:\d{4}[-\s]?){3}\d{4}\b", r"regexp_replace(x[2], '\d{12}(\d{4})', '**** **** **** \1', 'g')"),
]


def _sanitized(source: str, keys: str) -> str:
    for step in _LOG_STEPS:
        source = f"SELECT {keys}, {step} AS line FROM ({source})"
    return source


_STOP = ", ".join(f"'{word}'" for word in all_stop_words())
_EXTENSIONS = ", ".join(f"'{extension}'" for extension in ACCEPTED_EXTENSIONS)
_SEARCH = "('nation', 'the', 'und', 'que', 'tion')"


def _keywords(source: str, key: str, text: str) -> str:
    """(key, keywords) of every row with at least one keyword."""
    return rf"""
        SELECT {key}, string_agg(term, ',' ORDER BY n DESC, term) AS keywords
        FROM (SELECT {key}, term, count(*) AS n, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, term) AS rn
              FROM (SELECT {key}, unnest(list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}]+'),
                                         lambda x: x <> '')) AS term FROM {source})
              WHERE term NOT IN ({_STOP}) GROUP BY {key}, term)
        WHERE rn <= 10 GROUP BY {key}"""


def _ranked_profile(groups: str) -> str:
    return f"""(SELECT {groups}, kind, entry FROM
                  (SELECT {groups}, kind, entry,
                          row_number() OVER (PARTITION BY {groups}, kind ORDER BY sum(n) DESC, entry) AS rn
                   FROM entries GROUP BY {groups}, kind, entry) WHERE rn <= 300)"""


def _languages(source: str, key: str, text: str, fold: str = "0", match: str = "TRUE") -> str:
    """(key, language) of every row some word or trigram of which is in ``profile``.

    A clear winner by words decides; else the winner by trigrams of the words
    written one blank apart.
    """
    return rf"""
        SELECT {key}, coalesce(max(lang) FILTER (WHERE kind = 'word' AND place = 1 AND hits > next_hits),
                               max(lang) FILTER (WHERE kind = 'gram' AND place = 1)) AS language
        FROM (SELECT *, row_number() OVER (PARTITION BY {key}, kind ORDER BY hits DESC, lang) AS place,
                     coalesce(lead(hits) OVER (PARTITION BY {key}, kind ORDER BY hits DESC, lang), 0) AS next_hits
              FROM (SELECT {key}, p.kind, p.lang, count(*) AS hits
                    FROM (SELECT {key}, fold, 'word' AS kind, unnest(w) AS entry FROM worded
                          UNION ALL
                          SELECT {key}, fold, 'gram', unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2]))
                          FROM (SELECT {key}, fold, string_split(' ' || array_to_string(w, ' ') || ' ', '') AS c FROM worded)) g
                    JOIN profile p ON p.kind = g.kind AND p.entry = g.entry AND {match}
                    GROUP BY {key}, p.kind, p.lang))
        GROUP BY {key}""".replace(
        "FROM worded",
        rf"""FROM (SELECT {key}, {fold} AS fold, list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}]+'), lambda x: x <> '') AS w
                     FROM {source} WHERE length({_strip(text)}) > 10 OR {fold} > 0)""",
    )


_ENTITY_RULES = [
    ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("URL", r'https?://[^\s<>"]+'),
    ("DATE", r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b"),
    ("MONEY", r"[$€£][0-9][0-9.,]*"),
    ("PART_NO", r"\bPN-[0-9]+\b"),
    ("CARDINAL", r"\b[0-9]+\b"),
]


def _entity_list(text: str) -> str:
    lists = [
        f"list_transform(regexp_extract_all({text}, '{pattern}'), lambda m: '{label}:' || m)"
        for label, pattern in _ENTITY_RULES
    ]
    joined = lists[0]
    for more in lists[1:]:
        joined = f"list_concat({joined}, {more})"
    return joined


_REASON = f"""CASE WHEN size IS NULL THEN 'missing' WHEN size = 0 THEN 'empty' WHEN content IS NULL THEN 'no_content'
                   WHEN {_strip("content")} = '' THEN 'blank' END"""
_ISO = """CASE WHEN date_part('microsecond', ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
               ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END"""
_NAME = "regexp_extract(path, '([^/]*)$', 1)"
_UID = "substring(sha256(concat(path, '20240301_000000')), 1, 8)"


def _snapshot(year: int) -> str:
    return f"""
        SELECT PartID, PartNumber, Nomenclature, u.Mass, CreatedBy FROM parts
        JOIN (SELECT l_partkey, CAST(max(l_quantity) AS DECIMAL(10,2)) AS Mass FROM lineitem
              WHERE l_shipdate >= TIMESTAMP '{year}-01-01' AND l_shipdate < TIMESTAMP '{year + 1}-01-01'
              GROUP BY l_partkey) u ON u.l_partkey = PartID"""


def _violation(rule: str, table: str, column: str, value: str, source: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{table}' AS table_name, '{column}' AS column_name, "
        f"{value} AS key_value, n_rows FROM ({source})"
    )


_DQ = {
    "dq_not_null": [
        _violation("not_null", t, c, "CAST(NULL AS VARCHAR)", f"SELECT count(*) AS n_rows FROM {s} WHERE {c} IS NULL HAVING count(*) > 0")
        for t, c, s in [("events", "DurationSeconds", "log"), ("events", "ErrorLog", "log"), ("parts", "PartNumber", "parts")]
    ],
    "dq_unique": [
        _violation("unique", t, c, "CAST(k AS VARCHAR)", f"SELECT {e} AS k, count(*) AS n_rows FROM {t} GROUP BY 1 HAVING count(*) > 1 AND k IS NOT NULL")
        for t, c, e in [("documents", "text_md5", "md5(text)"), ("part", "p_name", "p_name"), ("parts", "PartNumber", "PartNumber")]
    ],
    "dq_orphans": [
        _violation("foreign_key", t, c, "CAST(k AS VARCHAR)", f"SELECT {c} AS k, count(*) AS n_rows FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pc} FROM {p} WHERE {pc} IS NOT NULL) GROUP BY 1")
        for t, c, p, pc in [("documents", "doc_id", "labels", "doc_id"), ("customer", "c_custkey", "orders", "o_custkey"), ("bom", "PartID", "parts", "PartID")]
    ],
    "dq_check_positive": [
        _violation("check", t, c, "CAST(k AS VARCHAR)", f"SELECT {c} AS k, count(*) AS n_rows FROM {s} WHERE NOT ({c} > 0) GROUP BY 1")
        for t, c, s in [("labels", "toxic", "labels"), ("components", "ParentPartID", "part_components"), ("bom", "Quantity", "bom")]
    ],
}
_DQ_VIEWS = _needs("log parts bom part_components")

_TAG_END = r"""(?:[^>=]+|=\s*(?:"[^"]*"|''[^'']*'')?)*(?:>|\z)"""
_HIDDEN = "".join(rf"<{tag}\b{_TAG_END}.*?(?:</{tag}\b[^>]*(?:>|\z)|\z)|" for tag in ("script", "style"))
_NAMED = ", ".join(f"'{name}': {code}" for name, code in (name2codepoint | {"lang": 0x27E8, "rang": 0x27E9, "apos": 39, "nbsp": 32}).items())
_WINDOWS = {code: bytes([code]).decode("cp1252", errors="ignore") for code in range(0x80, 0xA0)}
_MENDED = ", ".join(f"{code}: {ord(char)}" for code, char in (_WINDOWS | {0xA0: " "}).items() if char)


def _unescaped(text: str) -> str:
    """The text with named and numbered character references turned into characters."""
    found = [rf"regexp_extract(p, '^{form};', 1)" for form in ("#0*([0-9]{1,7})", "#[xX]0*([0-9a-fA-F]{1,6})", "([a-zA-Z][a-zA-Z0-9]*)")]
    code = f"CASE WHEN {found[0]} <> '' THEN CAST({found[0]} AS INT) WHEN {found[1]} <> '' THEN CAST('0x' || {found[1]} AS INT) END"
    number = f"list_transform([{code}], lambda c: CASE WHEN c = 0 OR c BETWEEN 55296 AND 57343 OR c > 1114111 THEN 65533 ELSE coalesce(MAP {{{_MENDED}}}[c], c) END)[1]"
    char = f"coalesce({number}, MAP {{{_NAMED}}}[{found[2]}])"
    piece = f"coalesce(chr({char}) || substr(p, strpos(p, ';') + 1), '&' || p)"
    return f"array_to_string(list_transform(string_split({text}, '&'), lambda p, i: CASE WHEN i = 1 THEN p ELSE {piece} END), '')"


ORACLE_SQL: dict[str, str] = {
    "extract_html_text": rf"""
        SELECT page_id, {_strip(f"regexp_replace({_unescaped('bare')}, '{WS}+', ' ', 'g')")} AS content,
               {_strip(_unescaped("title"))} AS title, lang, 'html' AS extraction_method
        FROM (SELECT page_id,
                     regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title,
                     regexp_extract(html, '(?is)<html[^>]*\slang="([^"]*)"', 1) AS lang,
                     regexp_replace(html, '(?is){_HIDDEN}<!--.*?(?:-->|\z)|<[!?][^>]*(?:>|\z)|</?[a-z]{_TAG_END}', ' ', 'g') AS bare
              FROM pages)""",
    "scan_table": "SELECT * FROM customer",
    "preview_table": "SELECT * FROM nation ORDER BY n_nationkey LIMIT 20",
    "json_document_sink": f"""{_needs("files")}
        SELECT file_id, concat(CASE WHEN path LIKE '%.txt' THEN {_NAME} ELSE 'doc' END, '_20240301_000000.json') AS file_name,
               CAST(json_object('file_id', file_id, 'path', path, 'content', content, 'lang', lang) AS VARCHAR) AS document
        FROM files""",
    "inverted_index": f"{_needs('words')} SELECT term, doc_id, count(*) AS tf FROM words GROUP BY term, doc_id",
    "term_stats": f"""{_needs("words")}
        SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM words GROUP BY term""",
    "search_terms": f"""{_needs("words index")},
        idf AS (SELECT term, ln((SELECT count(*) FROM documents) / count(*)) AS idf FROM index
                WHERE term IN {_SEARCH} GROUP BY term)
        SELECT doc_id, round(sum(tf * idf), 6) AS score FROM index JOIN idf USING (term)
        GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 20""",
    "phrase_search": r"""
        WITH listed AS (SELECT doc_id, regexp_extract_all(lower(text), '\p{L}+') AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM listed)
        SELECT doc_id, count(*) AS n FROM starts WHERE w[i] = 'and' AND w[i + 1] = 'attion' AND w[i + 2] = 'to' GROUP BY doc_id""",
    "index_blocks": f"""{_needs("words index")}
        SELECT term, doc_id // 256 AS block, CAST(count(*) AS INTEGER) AS n, CAST(max(tf) AS INTEGER) AS max_tf,
               CAST(min(doc_id % 256) AS INTEGER) AS first_offset, CAST(sum(tf) AS INTEGER) AS n_places
        FROM index GROUP BY term, block""",
    "facet_counts": f"""{_needs("words")}
        SELECT lang, source, count(*) AS n_docs FROM documents
        WHERE doc_id IN (SELECT doc_id FROM words WHERE term IN {_SEARCH}) GROUP BY lang, source""",
    "manifest_append": f"""{_needs("log")}
        SELECT event_id, concat({_ISO}, ' | ', Status, ' | ', {_NAME}) AS line FROM log""",
    "manifest_latest": f"""{_needs("log")}
        SELECT path, arg_max(Status, (ts, event_id)) AS status FROM log GROUP BY path""",
    "processing_log": f"""{_needs("log runs failures")}
        SELECT FileID, concat('Processing file: ', path) AS LogMessage, 'INFO' AS LogLevel FROM runs WHERE Status = 'Processing'
        UNION ALL
        SELECT FileID, concat('File processed successfully in ', CAST(DurationSeconds AS VARCHAR), ' seconds.'), 'INFO'
        FROM runs WHERE Status = 'Completed'
        UNION ALL
        SELECT FileID, concat('Error processing file: ', ErrorLog), 'ERROR' FROM failures
        UNION ALL
        SELECT FileID, concat('Retry attempt ', attempt, ' for file: ', path), 'WARNING' FROM failures WHERE Status = 'Retried'
        UNION ALL
        SELECT FileID, 'File processing failed after max retries.', 'ERROR' FROM failures WHERE Status = 'Failed'""",
    "handover_manifest": f"""{_needs("files")},
        named AS (SELECT path, content, {_NAME} AS name,
                         concat(regexp_extract({_NAME}, '^(.*)\\.', 1), '_20240301_000000_', {_UID}) AS base FROM files),
        targeted AS (SELECT *, concat(base, regexp_extract(name, '(\\.[^.]*)$', 1)) AS target FROM named)
        SELECT path, target AS embarkation_file, concat(base, '.meta.json') AS meta_file, sha256(content) AS sha256,
               CAST(json_object('original_file', name, 'embarkation_file', target, 'sha256', sha256(content),
                    'timestamp', '20240301_000000', 'source_path', path, 'destination_path', concat('/embarkation/', target),
                    'plm_trace_id', 'unknown', 'alm_trace_id', 'unknown', 'processed_by', 'data_pipeline') AS VARCHAR) AS manifest
        FROM targeted""",
    "route_failed": f"""{_needs("files faulty")}
        SELECT file_id, path, reason, CASE WHEN reason IS NULL THEN 'archive' ELSE 'failed' END AS route
        FROM (SELECT file_id, path, {_REASON} AS reason FROM faulty)""",
    "validate_files": f"{_needs('files faulty')} SELECT file_id, size, {_REASON} AS reason FROM faulty",
    "hidden_filter": f"{_needs('files landing_names')} SELECT * FROM landing_names WHERE path NOT LIKE '/staging/.%'",
    "extension_filter": f"""{_needs("files")}
        SELECT file_id, path FROM files WHERE lower(regexp_extract(path, '(\\.[^./]*)$', 1)) IN ({_EXTENSIONS})""",
    "retention_expired": f"""{_needs("files")},
        aged AS (SELECT file_id, path, {AS_OF} - to_days(CAST(age_days AS INTEGER))
                        - to_seconds(CASE WHEN source = 'src0' THEN 1 ELSE 0 END) AS modified FROM files)
        SELECT * FROM aged WHERE modified < {AS_OF} - INTERVAL 30 DAYS""",
    "extract_fallback": f"""{_needs("files")}
        SELECT file_id, CASE WHEN path LIKE '%.bin' THEN concat('ocr ', content) ELSE content END AS content,
               CASE WHEN path LIKE '%.bin' THEN 'tesseract' ELSE 'tika' END AS extraction_method FROM files""",
    "merge_metadata": f"""
        SELECT doc_id AS file_id, concat('lang=', lang, ';source=', source, ';words=', {_words_of("text")}) AS metadata
        FROM documents""",
    **{name: f"{_DQ_VIEWS} " + " UNION ALL ".join(parts) for name, parts in _DQ.items()},
    "dq_report": f"""{_DQ_VIEWS}
        SELECT rule, table_name, column_name, count(*) AS n_values, CAST(sum(n_rows) AS BIGINT) AS n_rows
        FROM ({" UNION ALL ".join(part for parts in _DQ.values() for part in parts)})
        GROUP BY rule, table_name, column_name""",
    "surrogate_keys": """
        SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_seq, o_orderkey,
               CASE WHEN o_orderstatus = 'P' THEN '?' ELSE o_orderstatus END AS status FROM orders""",
    "appended_keys": """
        SELECT o_orderkey, o_orderdate, o_orderstatus,
               row_number() OVER (ORDER BY o_orderstatus, o_orderdate, o_orderkey) AS order_seq
        FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""",
    "get_product_parts": f"""{_needs("parts bom part_revisions change_management")}, used AS (
            SELECT PartID FROM bom WHERE ProductID = 201)
        SELECT PartNumber, Nomenclature, Revision, ChangeDescription
        FROM used JOIN part_revisions USING (PartID) JOIN parts USING (PartID)
             LEFT JOIN (SELECT PartID, ChangeDescription FROM change_management) USING (PartID)""",
    "product_parts": f"""{_needs("parts bom part_revisions change_management")}, told AS (
            SELECT PartID, unnest(coalesce(texts, [NULL])) AS ChangeDescription
            FROM parts LEFT JOIN (SELECT PartID, list(ChangeDescription) AS texts FROM change_management GROUP BY PartID)
                 USING (PartID))
        SELECT ProductID, PartNumber, Nomenclature, Revision, ChangeDescription
        FROM bom JOIN told USING (PartID) JOIN part_revisions USING (PartID) JOIN parts USING (PartID)""",
    "product_part_quantity": f"""{_needs("parts bom")}, per_part AS (
            SELECT ProductID, PartID, sum(Quantity) AS held FROM bom GROUP BY ALL)
        SELECT ProductID, PartNumber, CAST(sum(held) AS BIGINT) AS TotalQuantity
        FROM per_part JOIN parts USING (PartID) GROUP BY ALL""",
    "dedup_by_hash": f"""{_needs("files")}
        SELECT regexp_extract(min(path), '([^/]*)$', 1) AS filename, sha256(content) AS sha256, md5(content) AS md5
        FROM files WHERE age_days < 30 AND content NOT IN (SELECT content FROM files WHERE age_days >= 30)
        GROUP BY content""",
    "parts_audit": f"""{_needs("parts")}, o AS ({_snapshot(1998)}), n AS ({_snapshot(1999)})
        SELECT n.*, 'INSERT' AS Action FROM n WHERE PartID NOT IN (SELECT PartID FROM o)
        UNION ALL
        SELECT o.*, 'DELETE' FROM o WHERE PartID NOT IN (SELECT PartID FROM n)
        UNION ALL
        SELECT n.*, 'UPDATE' FROM n JOIN o USING (PartID)
        WHERE n.PartNumber IS DISTINCT FROM o.PartNumber OR n.Nomenclature IS DISTINCT FROM o.Nomenclature
           OR n.Mass IS DISTINCT FROM o.Mass OR n.CreatedBy IS DISTINCT FROM o.CreatedBy""",
    "effective_revision": f"""{_needs("revision_effectivity")}
        SELECT l_partkey, Revision, count(*) AS n_uses, CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) AS last_use
        FROM lineitem JOIN revision_effectivity e ON e.PartID = l_partkey AND CAST(l_shipdate AS DATE) >= e.UsedOn
             AND (e.EffectiveToDate IS NULL OR CAST(l_shipdate AS DATE) < e.EffectiveToDate)
        GROUP BY l_partkey, Revision""",
    "bom_explosion": f"""WITH RECURSIVE part_components AS ({VIEWS["part_components"]}),
        e AS (SELECT ParentPartID AS RootPartID, ChildPartID AS PartID, Quantity, 1 AS lvl FROM part_components
              UNION ALL
              SELECT e.RootPartID, c.ChildPartID, e.Quantity * c.Quantity, e.lvl + 1
              FROM e JOIN part_components c ON c.ParentPartID = e.PartID)
        SELECT RootPartID, PartID, CAST(sum(Quantity) AS BIGINT) AS TotalQuantity, CAST(min(lvl) AS BIGINT) AS FirstLevel
        FROM e GROUP BY RootPartID, PartID""",
    "where_used": f"""WITH RECURSIVE part_components AS ({VIEWS["part_components"]}),
        up AS (SELECT ChildPartID AS PartID, ParentPartID AS TopPartID, Quantity FROM part_components
               UNION ALL
               SELECT up.PartID, c.ParentPartID, up.Quantity * c.Quantity
               FROM up JOIN part_components c ON c.ChildPartID = up.TopPartID)
        SELECT PartID, TopPartID, CAST(sum(Quantity) AS BIGINT) AS TotalQuantity FROM up
        WHERE TopPartID NOT IN (SELECT ChildPartID FROM part_components) GROUP BY PartID, TopPartID""",
    "link_docs_to_parts": rf"""{_needs("parts")}
        SELECT DISTINCT doc_id, PartID, PartNumber
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\b[0-9]+\b')) AS token FROM documents)
        JOIN parts ON PartNumber = concat('PN-', token)""",
    "processing_metrics": f"""{_needs("log monitor")}
        SELECT count(*) AS TotalProcessed,
               CAST(sum(CASE WHEN Status = 'Failed' THEN 1 ELSE 0 END) AS BIGINT) AS TotalFailed,
               CAST(sum(CASE WHEN Status = 'Retried' THEN 1 ELSE 0 END) AS BIGINT) AS TotalRetried,
               CAST(avg(DurationSeconds) AS DECIMAL(10,2)) AS AvgProcessingTime FROM monitor""",
    "attempt_metrics": f"""{_needs("log")},
        t AS (SELECT count(*) FILTER (WHERE Status = 'Completed') AS ok,
                     count(*) FILTER (WHERE Status IN ('Failed', 'Retried')) AS bad,
                     sum(CASE WHEN Status = 'Completed' THEN CAST(DurationSeconds AS DECIMAL(18,6)) END) AS secs,
                     max(CASE WHEN Status = 'Completed' THEN ts END) AS last_ok FROM log)
        SELECT ok AS files_processed, bad AS files_failed,
               CASE WHEN ok + bad > 0 THEN round(ok / (ok + bad), 6) ELSE 0.0::DOUBLE END AS success_rate,
               CASE WHEN ok > 0 THEN round(CAST(secs AS DOUBLE) / ok, 6) ELSE 0.0::DOUBLE END AS average_processing_time,
               last_ok AS last_processed FROM t""",
    "recent_errors": f"""{_needs("log")}
        SELECT event_id, FileID, concat('Processing failed for ', path, ': ', ErrorLog) AS message
        FROM log WHERE Status IN ('Failed', 'Retried') ORDER BY ts DESC, event_id DESC LIMIT 10""",
    "throughput": f"""{_needs("log samples")}
        SELECT count(*) AS n_intervals, round(avg(n_processed / secs), 9) AS average_throughput
        FROM (SELECT n_processed, date_diff('second', previous_ts, sample_ts) AS secs FROM samples) WHERE secs > 0""",
    "metric_samples": f"{_needs('log samples')} SELECT * FROM samples",
    "batch_acceptance": """
        SELECT source, count(*) AS n_files, count(*) FILTER (WHERE quality = 1) AS n_success,
               avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END) >= 0.8 AS accepted
        FROM labels JOIN documents USING (doc_id) GROUP BY source""",
    "file_outcome": f"{_needs('log runs outcomes')} SELECT * FROM outcomes",
    "monitor_current": f"{_needs('log monitor')} SELECT * FROM monitor",
    "retry_schedule": f"""{_needs("log runs failures")},
        policy AS (SELECT * FROM (VALUES ('doubling_3', 3, NULL, false), ('doubling_3_trailing', 3, NULL, true),
                                         ('doubling_4', 4, NULL, false), ('fixed_5', 5, 2, true)) p(policy, attempts, fixed, last_too))
        SELECT policy, event_id, FileID, attempt,
               CASE WHEN attempt < attempts OR (attempt = attempts AND last_too)
                    THEN CAST(coalesce(fixed, pow(2, attempt)) AS BIGINT) END AS delay_seconds,
               CASE WHEN attempt < attempts THEN ts + to_seconds(CAST(coalesce(fixed, pow(2, attempt)) AS BIGINT)) END AS next_retry_at,
               attempt >= attempts AS is_final
        FROM failures, policy""",
    "failure_alerts": f"""{_needs("log runs outcomes")}
        SELECT FileID, failures AS retries, last_error AS error,
               concat('🚨 File Processing Failed 🚨', chr(10), 'File: /staging/file_', FileID, '.txt', chr(10),
                      'Retries: 3', chr(10), 'Error: ', last_error) AS message
        FROM outcomes WHERE outcome = 'failed'""",
    "top_keywords": f"""
        SELECT d.doc_id, coalesce(k.keywords, '') AS keywords
        FROM documents d LEFT JOIN ({_keywords("documents", "doc_id", "text")}) k ON k.doc_id = d.doc_id""",
    "mask_content_a": f"SELECT doc_id, {_mask_a('text')} AS masked FROM documents",
    "mask_content_b": f"SELECT doc_id, {_mask_b('text')} AS masked FROM documents",
    "sanitize_log": _sanitized("SELECT conv_id, turn, concat(role, ' ', text) AS line FROM conversations", "conv_id, turn"),
    "sanitize_documents": _sanitized("SELECT doc_id, text AS line FROM documents", "doc_id"),
    "pii_report": "SELECT doc_id, "
    + ", ".join(
        f"CAST(len(regexp_extract_all(text, '{pattern}')) AS BIGINT) AS n_{name}"
        for name, pattern in [
            ("card", r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b"),
            ("ssn", r"\b\d{3}-\d{2}-\d{4}\b"),
            ("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"),
            ("ip", r"\b(?:\d{1,3}\.){3}\d{1,3}\b"),
            ("mac", r"\b(?:[0-9a-fA-F]{2}:){5}[0-9a-fA-F]{2}\b"),
            ("password", "password="),
            ("phone", r"\d{3}[-.\s]?\d{3}[-.\s]?\d{4}"),
        ]
    )
    + " FROM documents",
    "encrypt_roundtrip": "SELECT doc_id, text FROM documents",
    "content_stats": f"SELECT doc_id, length(text) AS content_length, {_words_of('text')} AS word_count FROM documents",
    "detect_language": f"""{_needs("folds vocabulary entries")}, profile AS {_ranked_profile("lang")}
        SELECT d.doc_id, CASE WHEN length({_strip("d.text")}) > 10 THEN coalesce(l.language, 'und') END AS language
        FROM documents d LEFT JOIN ({_languages("documents", "doc_id", "text")}) l ON l.doc_id = d.doc_id""",
    "language_accuracy": f"""{_needs("folds vocabulary entries")}, profile AS {_ranked_profile("fold, lang")},
        folded AS (SELECT doc_id, text, CASE WHEN substring(md5(text), 1, 1) < '8' THEN 1 ELSE 2 END AS fold FROM documents)
        SELECT d.lang, count(*) AS n_texts, count(*) FILTER (WHERE g.language = d.lang) AS n_right
        FROM documents d
        LEFT JOIN ({_languages("folded", "doc_id", "text", "fold", "p.fold <> g.fold - 1")}) g ON g.doc_id = d.doc_id
        GROUP BY d.lang""",
    "extract_entities": f"""
        SELECT doc_id, split_part(e, ':', 1) AS label, substring(e, strpos(e, ':') + 1) AS text, count(*) AS n
        FROM (SELECT doc_id, unnest({_entity_list("text")}) AS e FROM documents) GROUP BY ALL""",
    "gazetteer_entities": rf"""{_needs("words")},
        names AS (SELECT DISTINCT regexp_extract(url, '^https?://(?:www\.|m\.)?([a-z]+)\.', 1) AS name FROM pages)
        SELECT doc_id, name, 'SITE' AS label, count(*) AS n FROM words JOIN names ON name = term GROUP BY doc_id, name""",
    "name_entities": r"""WITH heads AS (
            SELECT list_filter(regexp_split_to_array(lower(regexp_extract(html, '<h1>(.*?)</h1>', 1)), '[^\p{L}]+'), lambda x: x <> '') AS w
            FROM pages),
        names AS (SELECT DISTINCT array_to_string(w[1:n], ' ') AS name, n FROM heads, (VALUES (2), (3)) AS v(n) WHERE len(w) >= n),
        listed AS (
            SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda x: x <> '') AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS spot FROM listed),
        runs AS (SELECT doc_id, spot, n, array_to_string(w[spot : spot + n - 1], ' ') AS name
                 FROM starts, (VALUES (2), (3)) AS v(n) WHERE spot + n - 1 <= len(w)),
        matches AS (SELECT doc_id, spot, spot + max(n) AS after, arg_max(name, n) AS name
                    FROM runs JOIN names USING (name, n) GROUP BY doc_id, spot),
        folded AS (SELECT doc_id, list_reduce(
                       list({'spot': spot, 'after': after, 'kept': [name]} ORDER BY spot),
                       lambda state, x: CASE WHEN x.spot < state.after THEN state
                           ELSE {'spot': x.spot, 'after': x.after, 'kept': list_concat(state.kept, x.kept)} END).kept AS kept
                   FROM matches GROUP BY doc_id)
        SELECT doc_id, name, 'HEADING' AS label, count(*) AS n FROM (SELECT doc_id, unnest(kept) AS name FROM folded)
        GROUP BY doc_id, name""",
    "process_documents": f"""{_needs("files faulty folds vocabulary entries")}, profile AS {_ranked_profile("lang")},
        extracted AS (SELECT file_id, path, source, size, lang,
                             CASE WHEN path LIKE '%.bin' THEN concat_ws('', 'ocr ', content) ELSE content END AS content,
                             CASE WHEN path LIKE '%.bin' THEN 'tesseract' ELSE 'tika' END AS extraction_method,
                             path LIKE '%.bin' AND lang = 'de' AS gone FROM faulty),
        nulled AS (SELECT * REPLACE (CASE WHEN gone THEN NULL ELSE content END AS content) FROM extracted),
        checked AS (SELECT *, {_REASON} AS reason FROM nulled),
        masked AS (SELECT file_id, path, source, extraction_method, reason,
                          CASE WHEN reason IS NULL THEN sha256(content) END AS sha256,
                          CASE WHEN reason IS NULL THEN {_mask_a("content")} END AS content FROM checked)
        SELECT m.file_id, path, content, source, extraction_method, length(content) AS content_length,
               coalesce({_words_of("content")}, 0) AS word_count,
               CASE WHEN length({_strip("content")}) > 10 THEN coalesce(l.language, 'und') END AS language,
               coalesce(array_to_string({_entity_list("content")}, '|'), '') AS entities,
               CASE WHEN content IS NOT NULL THEN coalesce(k.keywords, '') END AS keywords, sha256,
               {AS_OF} AS processed_at, reason, CASE WHEN reason IS NULL THEN 'archive' ELSE 'failed' END AS route
        FROM masked m LEFT JOIN ({_keywords("masked", "file_id", "content")}) k ON k.file_id = m.file_id
             LEFT JOIN ({_languages("masked", "file_id", "content")}) l ON l.file_id = m.file_id""",
    "content_hashes": "SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5 FROM documents",
    "path_parts": f"""{_needs("files landing_names")}
        SELECT path, name, substring(name, 1, length(name) - length(ext)) AS stem, ext
        FROM (SELECT path, {_NAME} AS name, regexp_extract({_NAME}, '^\\.*[^.]+.*?(\\.[^.]*)$', 1) AS ext FROM landing_names)""",
    "time_formats": f"""
        SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS compact, strftime(ts, '%Y-%m-%d_%H-%M-%S') AS log_stamp,
               {_ISO} AS iso,
               concat(strftime(ts, '%a %b '), lpad(CAST(day(ts) AS VARCHAR), 2, ' '), strftime(ts, ' %H:%M:%S %Y')) AS ctime
        FROM events""",
    "json_parse": "SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events",
    "json_path": f"""{_needs("products")}
        SELECT ProductName, CAST(Configuration->'$.color' AS VARCHAR) AS Color, count(*) AS n FROM products GROUP BY ALL""",
    "map_default": """
        SELECT event_id, coalesce(json_extract_string(props, '$.k'), 'doc') AS present,
               coalesce(json_extract_string(props, '$.resourceName'), 'doc') AS absent FROM events""",
    "array_slices": r"""
        SELECT doc_id, array_to_string(w[1:10], ' ') AS head, array_to_string(w[-10:], ' ') AS tail
        FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda x: x <> '') AS w
              FROM documents)""",
    "conditional_update": f"""{_needs("products")}
        SELECT ProductID, ProductName, CASE WHEN ProductName = '1-URGENT'
               THEN '{{"color": "red", "size": "large", "material": "steel"}}' ELSE Configuration END AS Configuration
        FROM products""",
    "merge_by_key": f"""{_needs("parts")}, o AS ({_snapshot(1998)}), n AS ({_snapshot(1999)})
        SELECT * FROM n WHERE PartID % 13 <> 0 UNION ALL
        SELECT * FROM o WHERE PartID % 13 <> 0 AND PartID NOT IN (SELECT PartID FROM n)""",
    "stored_quantity": f"""{_needs("bom parts")}
        SELECT ProductID, PartNumber, CAST(sum(Quantity + CASE WHEN PartID % 5 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS TotalQuantity,
               count(*) AS Uses
        FROM bom JOIN parts USING (PartID) WHERE ProductID % 7 <> 0 GROUP BY ProductID, PartNumber""",
    "status_history": f"""{_needs("log")},
        pairs AS (SELECT FileID, event_id AS Seq, Status, lag(Status) OVER (PARTITION BY FileID ORDER BY event_id) AS was FROM log),
        acted AS (SELECT FileID, Seq, Status, CASE
                      WHEN Status = 'Failed' THEN CASE WHEN was <> 'Failed' THEN 'DELETE' END
                      WHEN was IS NULL OR was = 'Failed' THEN 'INSERT'
                      WHEN was <> Status THEN 'UPDATE' END AS Action FROM pairs)
        SELECT FileID, Seq AS ValidFrom, lead(Seq) OVER (PARTITION BY FileID ORDER BY Seq) AS ValidTo, Status, Action
        FROM acted WHERE Action IS NOT NULL""",
    "part_levels": f"""WITH RECURSIVE part_components AS ({VIEWS["part_components"]}),
        down AS (SELECT DISTINCT ParentPartID AS PartID, CAST(0 AS BIGINT) AS lvl FROM part_components
                 WHERE ParentPartID NOT IN (SELECT ChildPartID FROM part_components)
                 UNION SELECT ChildPartID, lvl + 1 FROM down JOIN part_components ON ParentPartID = PartID)
        SELECT PartID, max(lvl) AS Level FROM down GROUP BY PartID""",
    "bom_cycle_parts": f"""WITH RECURSIVE part_components AS ({VIEWS["part_components"]}),
        edges AS (SELECT ParentPartID AS a, ChildPartID AS b FROM part_components UNION
                  SELECT ChildPartID, ChildPartID // 25 FROM part_components WHERE ChildPartID % 97 = 0 AND ChildPartID >= 25),
        reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
        members AS (SELECT x.a AS PartID, min(x.b) AS CycleID FROM reach x JOIN reach y ON y.a = x.b AND y.b = x.a GROUP BY x.a)
        SELECT CycleID, PartID, count(*) OVER (PARTITION BY CycleID) AS Parts FROM members""",
    "add_column": f"""{_needs("products")}
        SELECT ProductID, ProductName, CAST(NULL AS VARCHAR) AS Configuration FROM products""",
}
