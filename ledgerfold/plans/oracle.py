"""For each query, SQL that derives the same rows in another engine.

Written on its own from the meaning of each operator, for DuckDB, over the
tables as they are.
"""

from __future__ import annotations

from ledgerfold.constants import (
    ARCHIVE_DETAIL,
    CLASS_CONFLICT_DETAIL,
    DATE_ANOMALY_DETAIL,
    DEEP_NESTING_DETAIL,
    EXT_MISMATCH_DETAIL,
    JUNK_DETAIL,
    LOW_CONFIDENCE_DETAIL,
    RULE_DOCS,
    RULE_SEVERITY,
    SEVERITY_DOCS,
    UNCLASSIFIED_DETAIL,
    WHITESPACE,
    ZERO_BYTE_DETAIL,
)

AS_OF = "DATE '2026-07-21'"
_WS = "'" + WHITESPACE + "'"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_text(v) for v in row) + ")" for row in rows)


# --- the derived collection --------------------------------------------------

_ADDED = "1000000000000"
_TYPE = """CASE WHEN {0} = '' THEN 'empty' WHEN starts_with({0}, '%PDF') THEN 'pdf'
  WHEN starts_with({0}, 'PK' || chr(3) || chr(4)) THEN 'zip'
  WHEN starts_with({0}, 'GIF87a') OR starts_with({0}, 'GIF89a') THEN 'gif' ELSE 'text' END"""

DM = f"""
files AS (SELECT doc_id, lang, source, coalesce(text, '') AS body FROM documents
  UNION ALL SELECT doc_id + {_ADDED}, lang, source, '' FROM documents WHERE doc_id % 97 = 0),
base AS (SELECT *, CAST(doc_id AS VARCHAR) AS n, CAST(doc_id - 1 AS VARCHAR) AS p FROM files),
named AS (SELECT *,
    CASE doc_id % 8 WHEN 0 THEN 'Invoices/' WHEN 1 THEN 'Contracts/' WHEN 2 THEN 'Correspondence/'
      WHEN 3 THEN 'Reports/' WHEN 4 THEN 'Site Photos/' WHEN 5 THEN 'Old Files/2019 archive/deep/nested/'
      WHEN 6 THEN '' ELSE 'Reports/Archive/' END
      || CASE WHEN doc_id % 17 = 8 THEN 'b' || n || '/' ELSE '' END AS folder,
    CASE doc_id % 17 WHEN 0 THEN 'Copy of doc_' || n || '.txt' WHEN 1 THEN 'doc_' || n || ' (1).txt'
      WHEN 2 THEN 'doc_' || n || ' - Copy.txt' WHEN 3 THEN 'doc_' || p || '_v2.txt'
      WHEN 4 THEN 'doc_' || n || ' FINAL.txt' WHEN 5 THEN 'scan_' || n || '.pdf'
      WHEN 6 THEN 'doc_' || n || '.TXT' WHEN 7 THEN '~$doc_' || n || '.docx'
      WHEN 8 THEN 'Thumbs.db' WHEN 9 THEN 'doc_' || n || '.zip'
      WHEN 10 THEN 'doc_' || n || '!!.txt' ELSE 'doc_' || n || '.txt' END AS name
  FROM base),
dm AS (SELECT doc_id, lang, source, body, name, folder || name AS inner_path,
    rtrim(folder, '/') AS folder, 'corpus/' || folder || name AS path,
    regexp_extract(name, '(?s)^.+(\\.[^.]+)$', 1) AS extension,
    {_TYPE.format('body')} AS true_type,
    CAST(strlen(body) AS BIGINT) AS size_bytes, sha256(body) AS sha256,
    CASE WHEN doc_id % 101 = 0 THEN DATE '1980-05-12' WHEN doc_id % 103 = 0 THEN DATE '2031-01-15'
      ELSE CAST(DATE '2026-01-01' + CAST(doc_id % 180 AS INT) AS DATE) END AS modified,
    CASE WHEN doc_id % 5 = 0 THEN 'Unassigned' ELSE 'Author ' || source END AS author
  FROM named),
stemmed AS (SELECT *, substr(name, 1, length(name) - length(extension)) AS stem0,
    lower(name) AS low, lower(extension) AS lext,
    starts_with(name, '~$') OR lower(name) IN ('thumbs.db', '.ds_store', 'desktop.ini') AS junk,
    CAST(greatest(0, len(string_split(path, '/')) - 2) AS BIGINT) AS depth
  FROM dm),
m AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(stem0),
      '^copy of ', ''), '\\s*\\([0-9]+\\)$', ''), '\\s*-\\s*copy$', ''), '_v[0-9]+$', '')) AS stem,
    concat_ws('; ',
      CASE WHEN regexp_matches(name, '\\s') THEN 'contains spaces' END,
      CASE WHEN extension <> lext THEN 'non-lowercase extension ''' || extension || '''' END,
      CASE WHEN contains(low, 'final') OR contains(low, 'use this one') OR contains(low, '!!')
        THEN 'ad-hoc status word(s): ' || concat_ws(', ',
          CASE WHEN contains(low, 'final') THEN 'final' END,
          CASE WHEN contains(low, 'use this one') THEN 'use this one' END,
          CASE WHEN contains(low, '!!') THEN '!!' END) END,
      CASE WHEN regexp_full_match(lower(stem0), 'scan_[0-9]+')
        THEN 'scanner-default name (no document identity)' END) AS reasons,
    CASE lext WHEN '.pdf' THEN 'pdf' WHEN '.png' THEN 'png' WHEN '.jpg' THEN 'jpg' WHEN '.jpeg' THEN 'jpg'
      WHEN '.gif' THEN 'gif' WHEN '.docx' THEN 'zip' WHEN '.xlsx' THEN 'zip' WHEN '.pptx' THEN 'zip'
      WHEN '.zip' THEN 'zip' WHEN '.doc' THEN 'ole' WHEN '.xls' THEN 'ole' WHEN '.ppt' THEN 'ole'
      WHEN '.txt' THEN 'text' WHEN '.csv' THEN 'text' ELSE '' END AS expected,
    CASE WHEN regexp_matches(lower(inner_path), '^reports/archive/') THEN 0
      WHEN regexp_matches(lower(inner_path), '\\.zip$') THEN 1
      WHEN regexp_matches(lower(inner_path), '^invoices/') THEN 2
      WHEN regexp_matches(lower(inner_path), '^contr.cts/') THEN 3
      WHEN regexp_matches(lower(inner_path), '^[^x]orrespondence/') THEN 4
      WHEN regexp_matches(lower(inner_path), '^reports/') THEN 5
      WHEN regexp_matches(lower(inner_path), '/doc_[0-4].*_v2\\.txt$') THEN 6
      WHEN regexp_matches(lower(inner_path), '^site photos/[a-c]') THEN 7 ELSE -1 END AS rule_order
  FROM stemmed),
mc AS (SELECT *, CASE rule_order WHEN 0 THEN 'Archive Desk' WHEN 1 THEN 'Backup Desk' WHEN 2 THEN 'Accounts'
    WHEN 3 THEN 'Legal' WHEN 4 THEN 'Mail Room' WHEN 5 THEN 'Operations' WHEN 6 THEN 'Author src3'
    WHEN 7 THEN 'Field Tablet' ELSE 'Unassigned' END AS custodian FROM m)"""

# --- classification ----------------------------------------------------------

CLS = f"""
tok AS (SELECT path, name, doc_id, lang, body,
    ' ' || regexp_replace(lower(body), '[^a-zà-ÿ]+', '  ', 'g') || ' ' AS t,
    length(trim(body, {_WS})) AS trimmed FROM dm),
hit AS (SELECT *,
    len(regexp_extract_all(t, ' (?:der|die|und|von) ')) AS de,
    len(regexp_extract_all(t, ' (?:the|and|of|to) ')) AS en,
    len(regexp_extract_all(t, ' (?:el|los|del|y) ')) AS es,
    len(regexp_extract_all(t, ' (?:et|le|les|est) ')) AS fr FROM tok),
best AS (SELECT *, greatest(de, en, es, fr) AS top, de + en + es + fr AS total FROM hit),
cls AS (SELECT path, name, doc_id, lang, CAST(length(body) AS BIGINT) AS chars,
    CASE WHEN trimmed < 20 THEN 'unclassified' WHEN top = 0 THEN 'other' WHEN de = top THEN 'de'
      WHEN en = top THEN 'en' WHEN es = top THEN 'es' ELSE 'fr' END AS label,
    CAST(CASE WHEN trimmed < 20 OR total = 0 THEN 0.0
      ELSE CAST((top * 200 + total) // (total * 2) AS DOUBLE) / 100 END AS DOUBLE) AS confidence,
    CASE WHEN doc_id % 29 = 0 THEN 'en' ELSE lang END AS folder_hint,
    CASE WHEN trimmed < 20 THEN 'no_text' ELSE 'ok' END AS status,
    CASE WHEN trimmed < 20 THEN 'no extractable text (' || trimmed || ' chars)'
      ELSE top || ' of ' || total || ' keyword hits' END AS reason
  FROM best)"""

CLS_COLUMNS = "path, name, chars, label, confidence, folder_hint, status, reason"

# --- findings ----------------------------------------------------------------

def _filled(template: str, *values: str) -> str:
    """SQL that puts values in the places of a text."""
    parts = [_text(part) for part in template.split("{}")]
    return " || ".join(piece for pair in zip(parts, [*values, ""]) for piece in pair if piece)


_ROW_RULES = {
    "ZERO_BYTE": ("size_bytes = 0 OR true_type = 'empty'", _text(ZERO_BYTE_DETAIL)),
    "JUNK_FILE": ("junk", _text(JUNK_DETAIL)),
    "ARCHIVE": (
        "lext IN ('.zip', '.rar', '.7z', '.tar', '.gz', '.tgz')",
        _text(ARCHIVE_DETAIL),
    ),
    "EXT_MISMATCH": (
        "NOT junk AND true_type NOT IN ('empty', 'unknown') AND expected <> '' AND expected <> true_type",
        _filled(EXT_MISMATCH_DETAIL, "lext", "true_type"),
    ),
    "DATE_ANOMALY": (
        f"year(modified) < 2000 OR modified > {AS_OF}",
        _filled(DATE_ANOMALY_DETAIL, "strftime(modified, '%Y-%m-%d')", "'2026-07-21'"),
    ),
    "DEEP_NESTING": ("depth > 2", _filled(DEEP_NESTING_DETAIL, "depth")),
    "NAMING": ("NOT junk AND reasons <> ''", "reasons"),
}
_CLASS_RULES = {
    "UNCLASSIFIED": ("status <> 'ok'", _filled(UNCLASSIFIED_DETAIL, "reason")),
    "CLASS_CONFLICT": (
        "status = 'ok' AND folder_hint <> '' AND label <> folder_hint",
        _filled(CLASS_CONFLICT_DETAIL, "label", "folder_hint"),
    ),
    "LOW_CONFIDENCE": (
        "status = 'ok' AND confidence < 0.75",
        _filled(LOW_CONFIDENCE_DETAIL, "confidence", "'0.75'"),
    ),
}


def _rule(rule: str, source: str, condition: str, detail: str) -> str:
    return (
        f"SELECT path, name, '{rule}' AS rule_id, '{RULE_SEVERITY[rule]}' AS severity, "
        f"{detail} AS detail FROM {source} WHERE {condition}"
    )


def _group_rule(rule: str, key: str, intro: str, where: str, having: str) -> str:
    """All members of a group with the number of the others and the group's key."""
    return f"""SELECT d.path, d.name, '{rule}' AS rule_id, '{RULE_SEVERITY[rule]}' AS severity,
      '{intro}' || (g.n - 1) || ' other file(s) of group ' || d.{key} AS detail
    FROM m d JOIN (SELECT {key}, count(*) AS n FROM m WHERE {where} GROUP BY {key} HAVING {having}) g
      ON d.{key} = g.{key} WHERE {where}"""


EXACT = _group_rule("EXACT_DUP", "sha256", "identical bytes to: ", "size_bytes > 0", "count(*) > 1")
NEAR = _group_rule(
    "NEAR_DUP_NAME",
    "stem",
    "same base name, different content vs: ",
    "true",
    "count(*) > 1 AND count(DISTINCT sha256) > 1",
)
_FILE_FINDINGS = "\n UNION ALL ".join(_rule(r, "m", *spec) for r, spec in _ROW_RULES.items())
_CLASS_FINDINGS = "\n UNION ALL ".join(_rule(r, "cls", *spec) for r, spec in _CLASS_RULES.items())
_DUP_FINDINGS = f"{EXACT}\n UNION ALL {NEAR}"
FOUND = f"found AS ({_DUP_FINDINGS}\n UNION ALL {_FILE_FINDINGS}\n UNION ALL {_CLASS_FINDINGS})"

# --- axes --------------------------------------------------------------------

XREF = """
axis_rows AS (
  SELECT 'class' AS axis, mc.*, CASE WHEN cls.status = 'ok' THEN cls.label ELSE 'Unassigned' END AS bucket
    FROM mc JOIN cls USING (path)
  UNION ALL SELECT 'author' AS axis, mc.*, author AS bucket FROM mc
  UNION ALL SELECT 'custodian' AS axis, mc.*, custodian AS bucket FROM mc),
xref AS (SELECT axis, path AS original_path, folder AS original_folder, bucket,
    '/organized/by-' || axis || '/' || bucket || '/' || inner_path AS new_path, sha256, size_bytes,
    '' AS created, strftime(modified, '%Y-%m-%dT00:00:00') AS modified FROM axis_rows)"""

SEEDED = f"""
seeded AS (
  SELECT 'zero-byte' AS type, path, 'ZERO_BYTE' AS rule_id FROM dm WHERE doc_id >= {_ADDED}
  UNION ALL SELECT 'date-anomaly', path, 'DATE_ANOMALY' FROM dm WHERE doc_id % 101 = 0 OR doc_id % 103 = 0
  UNION ALL SELECT 'junk-file', path, 'JUNK_FILE' FROM dm WHERE doc_id % 17 IN (7, 8)
  UNION ALL SELECT 'archive', path, 'ARCHIVE' FROM dm WHERE doc_id % 17 = 9
  UNION ALL SELECT 'deep-nesting', path, 'DEEP_NESTING' FROM dm WHERE doc_id % 8 = 5
  UNION ALL SELECT 'exact-duplicate', path, 'EXACT_DUP' FROM dm
    WHERE lang = 'es' AND doc_id % 17 IN (0, 1, 2, 4, 5, 6, 10)
  UNION ALL SELECT 'lost-page', path, '' FROM dm WHERE lang = 'es' AND doc_id % 17 = 7
  UNION ALL SELECT 'naming-violation', path, 'NAMING' FROM dm WHERE doc_id % 17 IN (0, 1, 2, 4, 5, 6, 10))"""

TRUTH = f"""
truth AS (SELECT path, CASE WHEN doc_id >= {_ADDED} THEN NULL WHEN doc_id % 13 = 0 THEN [lang, 'other']
    ELSE [lang] END AS accepted FROM dm)"""

ALL = (DM, CLS, FOUND)


def _with(ctes, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _dm(select: str) -> str:
    return _with((DM,), select)


def _cls(select: str) -> str:
    return _with((DM, CLS), select)


def _found(select: str) -> str:
    return _with(ALL, select)


def _xref(select: str) -> str:
    return _with((DM, CLS, XREF), select)


def _everything(select: str) -> str:
    return _with((DM, CLS, FOUND, XREF, SEEDED, TRUTH), select)


_MANIFEST = (
    "path, name, extension, true_type, size_bytes, sha256, '' AS created, "
    "strftime(modified, '%Y-%m-%dT00:00:00') AS modified, author, '/collections/corpus' AS collection_root"
)
_SEVERITY_ORD = "CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 END"
_LABEL_FOLDER = "CASE WHEN trim(folder, '/.') = '' THEN '(intake root)' ELSE trim(folder, '/.') END"
_DOCS = f"docs AS (SELECT * FROM (VALUES {_values((r, RULE_SEVERITY[r], t) for r, t in RULE_DOCS.items())}) v(rule_id, severity, description))"
_MEANINGS = f"meanings AS (SELECT * FROM (VALUES {_values(SEVERITY_DOCS.items())}) v(severity, meaning))"
_SEVERITIES = "(VALUES ('high', 0), ('medium', 1), ('low', 2)) s(severity, ord)"

_PAGE = "regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '')"
_PAGE_INNER = "CASE WHEN contains(p, '/') THEN substr(p, instr(p, '/') + 1) ELSE '' END"

_FIGURES = """SELECT 'total_files' AS figure, (SELECT count(*) FROM dm) AS value
  UNION ALL SELECT 'files_flagged', (SELECT count(DISTINCT path) FROM found)
  UNION ALL SELECT 'files_clean', (SELECT count(*) FROM dm WHERE path NOT IN (SELECT path FROM found))
  UNION ALL SELECT 'total_exceptions', (SELECT count(*) FROM found)
  UNION ALL SELECT 'sev_' || s.severity, (SELECT count(*) FROM found f WHERE f.severity = s.severity)
    FROM (VALUES ('high'), ('medium'), ('low')) s(severity)
  UNION ALL SELECT 'naming_findings', (SELECT count(*) FROM found WHERE rule_id = 'NAMING')
  UNION ALL SELECT 'class_labeled', (SELECT count(*) FROM cls WHERE label <> 'unclassified')
  UNION ALL SELECT 'class_unclassified', (SELECT count(*) FROM cls WHERE label = 'unclassified')
  UNION ALL SELECT 'files_' || axis, count(*) FROM xref GROUP BY axis
  UNION ALL SELECT 'unassigned_' || axis, count(*) FILTER (bucket = 'Unassigned') FROM xref GROUP BY axis
  UNION ALL SELECT 'buckets_' || axis, count(DISTINCT bucket) FROM xref GROUP BY axis
  UNION ALL SELECT f, (SELECT count(*) FROM xref) FROM (VALUES ('datefid_total'), ('datefid_ok')) v(f)"""

_SUMMARY = """, counts AS (SELECT axis, bucket, count(*) AS files FROM xref GROUP BY ALL)
SELECT axis, CAST(sum(files) AS BIGINT) AS files, count(*) AS buckets,
  CAST(coalesce(sum(files) FILTER (bucket = 'Unassigned'), 0) AS BIGINT) AS unassigned,
  coalesce(first(bucket ORDER BY files DESC, bucket) FILTER (bucket <> 'Unassigned'), '-') AS top_bucket,
  coalesce(max(files) FILTER (bucket <> 'Unassigned'), 0) AS top_files FROM counts"""


def _clashes(dest: str) -> str:
    return _dm(f""", plan AS (SELECT {dest} AS dest, path FROM m),
      firsts AS (SELECT dest, min(path) AS first_path FROM plan GROUP BY dest)
    SELECT dest, first_path, path FROM plan JOIN firsts USING (dest) WHERE path <> first_path""")


def _recon(classified: str) -> str:
    return f"""SELECT *, CASE WHEN left_value = right_value THEN 'match' ELSE 'MISMATCH' END AS ok FROM (
  SELECT 'classified files = files' AS "check",
    (SELECT count(*) FROM {classified}) AS left_value, (SELECT count(*) FROM dm) AS right_value
  UNION ALL SELECT 'flagged + clean files = files',
    (SELECT count(*) FROM (SELECT path FROM found UNION SELECT path FROM dm)), (SELECT count(*) FROM dm)
  UNION ALL SELECT 'findings of known severity = findings',
    (SELECT count(*) FROM found WHERE severity IN ('high', 'medium', 'low')), (SELECT count(*) FROM found)
  UNION ALL SELECT 'unclassified files = UNCLASSIFIED findings',
    (SELECT count(*) FROM {classified} WHERE label = 'unclassified'),
    (SELECT count(*) FROM found WHERE rule_id = 'UNCLASSIFIED')
  UNION ALL SELECT 'copies by ' || axis || ' = files', count(*), (SELECT count(*) FROM dm) FROM xref GROUP BY axis
  UNION ALL SELECT 'times kept = times compared', (SELECT count(*) FROM xref), (SELECT count(*) FROM xref))"""


_RAW_LABEL = """CASE doc_id % 9 WHEN 2 THEN source WHEN 5 THEN '' WHEN 7 THEN lang || '''s'
  WHEN 8 THEN 'other' ELSE lang END"""

_ASKED = """
asked AS (SELECT path, name, chars, folder_hint, lang, label, confidence, status,
    CASE WHEN status <> 'ok' THEN reason ELSE replace(reason, ' keyword hits', '') END AS reason,
    CASE WHEN status <> 'ok' THEN '' WHEN chars % 50 = 7 THEN 'failed' WHEN chars % 50 = 9 THEN 'off' ELSE '' END AS how
  FROM cls),
judged AS (SELECT path, name, chars, folder_hint,
    CASE WHEN how <> '' THEN 'unclassified' ELSE label END AS label,
    CASE WHEN how <> '' THEN 0.0 ELSE confidence END AS confidence,
    CASE WHEN how <> '' THEN 'model_error' ELSE status END AS status,
    CASE how WHEN 'failed' THEN 'model call failed: ValueError'
      WHEN 'off' THEN 'model returned invalid label ''klingon''' ELSE reason END AS reason FROM asked)"""


# What is put in front of a document's text, and its name, by its number.
_BINARY = """WITH odd AS (SELECT *, 'corpus/' || doc_id || '/' || name AS path,
    CAST(CASE WHEN kind = 11 THEN 0 ELSE strlen(coalesce(text, '')) + 2 + front END AS BIGINT) AS size_bytes
  FROM (SELECT doc_id, text, doc_id % 12 AS kind,
    ['pdf', 'png', 'jpg', 'zip', 'ole', 'gif', 'gif', 'unknown', 'unknown', 'text', 'text', 'empty'][doc_id % 12 + 1] AS true_type,
    [8, 8, 3, 4, 4, 6, 6, 2, 4, 0, 2049, 0][doc_id % 12 + 1] AS front,
    ['.hidden', 'a' || chr(160) || 'b.PDF', 'x.docx', 'Scan_12.png', '.DS_Store', 'name.', 'c' || chr(12288) || 'd.jpg'][doc_id % 7 + 1] AS name,
    ['', '.PDF', '.docx', '.png', '', '', '.jpg'][doc_id % 7 + 1] AS extension,
    ['', 'pdf', 'zip', 'png', '', '', 'jpg'][doc_id % 7 + 1] AS want,
    ['.hidden', 'a' || chr(160) || 'b', 'x', 'scan_12', '.ds_store', 'name.', 'c' || chr(12288) || 'd'][doc_id % 7 + 1] AS stem,
    ['', 'contains spaces; non-lowercase extension ''.PDF''', '', 'scanner-default name (no document identity)', '', '', 'contains spaces'][doc_id % 7 + 1] AS reasons
  FROM documents))
"""


def all_sql() -> dict[str, str]:
    sql = {
        # scalar projections
        "path_parts": _dm("""SELECT path, inner_path, 'corpus' AS collection, path AS rebuilt,
          '/collections/corpus/' || inner_path AS source_path, '' AS inner_of_name FROM dm"""),
        "url_parts": f"""WITH p AS (SELECT page_id, html, {_PAGE} AS p FROM pages),
          q AS (SELECT *, {_PAGE_INNER} AS inner_path FROM p),
          r AS (SELECT *, CASE WHEN contains(inner_path, '/') THEN regexp_replace(inner_path, '/[^/]*$', '') ELSE '' END AS folder0 FROM q)
          SELECT page_id, string_split(p, '/')[1] AS host, inner_path,
            CAST(greatest(0, len(string_split(p, '/')) - 2) AS BIGINT) AS depth,
            CASE WHEN trim(folder0, '/.') = '' THEN '(intake root)' ELSE trim(folder0, '/.') END AS folder,
            {_TYPE.format('html')} AS true_type, sha256(html) AS sha256 FROM r""",
        "name_parts": _dm("SELECT path, name, stem0 AS stem, extension AS suffix FROM stemmed"),
        "folder_depth": _dm("SELECT path, depth AS folder_depth FROM stemmed"),
        "folder_label": _dm(f"SELECT path, {_LABEL_FOLDER} AS folder_label FROM dm"),
        "original_folder": _dm("SELECT path, folder AS original_folder FROM dm"),
        "folder_hint": _dm("""SELECT path, CASE WHEN NOT contains(inner_path, '/') THEN ''
          ELSE CASE string_split(inner_path, '/')[1] WHEN 'Invoices' THEN 'invoice' WHEN 'Contracts' THEN 'contract'
            WHEN 'Correspondence' THEN 'correspondence' WHEN 'Reports' THEN 'report' ELSE '' END END AS folder_hint FROM dm"""),
        "content_hash": _dm("SELECT path, sha256 AS content_hash FROM dm"),
        "true_type": _dm("SELECT path, true_type FROM dm"),
        "normalized_stem": _dm("SELECT path, stem AS normalized_stem FROM m"),
        "is_junk": _dm("SELECT path, CASE WHEN junk THEN 'true' ELSE 'false' END AS is_junk FROM m"),
        "naming_reasons": _dm("SELECT path, reasons AS naming_reasons FROM m"),
        "expected_type": _dm("SELECT path, expected AS expected_type FROM m"),
        "custodian_match": _dm("SELECT path, custodian AS custodian_match FROM mc"),
        "author_or_unassigned": """SELECT doc_id, source AS author FROM documents
          UNION ALL SELECT -1 - item_id, 'Unassigned' FROM benchmark""",
        "safe_bucket": """SELECT page_id, rtrim(regexp_replace(url, '[<>:"/\\\\|?*]', '_', 'g'), '. ') AS bucket FROM pages
          UNION ALL SELECT -1 - item_id, 'Unassigned' FROM benchmark""",
        "second_precision_time": "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS time FROM events",
        "text_window": "SELECT doc_id, CAST(length(substr(text, 1, 3000)) AS BIGINT) AS chars, sha256(substr(text, 1, 3000)) AS window_hash FROM documents",
        "readable_text_gate": _cls("""SELECT path, CASE WHEN status = 'ok' THEN 'readable' ELSE status END AS status,
          CASE WHEN status = 'ok' THEN '' ELSE reason END AS reason,
          CASE WHEN status = 'ok' THEN '' ELSE label END AS label FROM cls"""),
        "parse_model_answer": f"""WITH a AS (SELECT doc_id, source, lang, {_RAW_LABEL} AS given, doc_id % 9 AS k FROM documents),
          b AS (SELECT *, CASE WHEN k IN (3, 6) THEN 'model call failed: JSONDecodeError'
              WHEN k IN (2, 5) THEN 'model returned invalid label ''' || given || ''''
              WHEN k = 7 THEN 'model returned invalid label "' || given || '"' END AS failure FROM a)
          SELECT doc_id, CASE WHEN failure IS NULL THEN given ELSE 'unclassified' END AS label,
            CAST(CASE k WHEN 0 THEN CAST(doc_id % 90 + 10 AS DOUBLE) / 100 WHEN 1 THEN 0.5 WHEN 4 THEN CASE doc_id % 7
                WHEN 0 THEN 0.74 WHEN 1 THEN 0.12 WHEN 2 THEN 0.84 WHEN 3 THEN 0.28 WHEN 4 THEN 0.61 ELSE 0.0 END WHEN 8 THEN 0.99 ELSE 0.0 END AS DOUBLE) AS confidence,
            CASE WHEN failure IS NULL THEN 'ok' ELSE 'model_error' END AS status,
            coalesce(failure, CASE k WHEN 0 THEN 'reads as ' || lang WHEN 1 THEN 'shouting'
              WHEN 8 THEN repeat(source, 60) ELSE '' END) AS reason FROM b""",
        "severity_order": _found(f"SELECT path, rule_id, CAST({_SEVERITY_ORD} AS BIGINT) AS ord FROM found"),
        # the rule catalogue
        "rule_exact_dup": _dm(EXACT),
        "rule_near_dup_name": _dm(NEAR),
        "duplicate_members": _dm("""SELECT 'EXACT_DUP' AS rule_id, sha256 AS group_key, path, name, n FROM m
            JOIN (SELECT sha256, count(*) AS n FROM m WHERE size_bytes > 0 GROUP BY 1 HAVING count(*) > 1) USING (sha256) WHERE size_bytes > 0
          UNION ALL SELECT 'NEAR_DUP_NAME', stem, path, name, n FROM m
            JOIN (SELECT stem, count(*) AS n FROM m GROUP BY 1 HAVING count(*) > 1 AND count(DISTINCT sha256) > 1) USING (stem)"""),
        "date_range_check": """SELECT 'orders' AS table_name, count(*) AS "rows", count(*) FILTER (year(o_orderdate) < 2000 OR CAST(o_orderdate AS DATE) > DATE '2001-01-01') AS out_of_range FROM orders
          UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (year(l_shipdate) < 2000 OR CAST(l_shipdate AS DATE) > DATE '2001-01-01') FROM lineitem
          UNION ALL SELECT 'events', count(*), count(*) FILTER (year(ts) < 2000 OR CAST(ts AS DATE) > DATE '2001-01-01') FROM events""",
        "rule_docs": _with((DM, CLS, FOUND, _DOCS), """SELECT rule_id, docs.severity, description, count(found.path) AS findings
          FROM docs LEFT JOIN found USING (rule_id) GROUP BY ALL"""),
        # joins
        "axis_lookup": _dm("""SELECT path, author AS bucket FROM dm
          UNION ALL SELECT 'corpus/pages/' || page_id, 'Unassigned' FROM pages"""),
        "class_axis": _cls("SELECT path, CASE WHEN status = 'ok' THEN label ELSE 'Unassigned' END AS bucket FROM cls"),
        "author_axis": _dm("SELECT path, author AS bucket FROM dm"),
        "custodian_axis": _dm("SELECT path, custodian AS bucket FROM mc"),
        "crossref_to_manifest": _xref("""SELECT axis, original_path, new_path, 'known' AS verdict FROM xref
          UNION ALL SELECT 'class', 'corpus/pages/' || page_id, '/organized/pages/' || page_id, 'not in manifest' FROM pages"""),
        "rule_to_doc": _with((*ALL, _DOCS, _MEANINGS),
            "SELECT f.path, rule_id, f.severity, description, meaning FROM found f JOIN docs USING (rule_id) JOIN meanings m2 ON m2.severity = f.severity"),
        "first_match_join": _dm(""", rules AS (
            SELECT doc_id AS rule_order, doc_id % 3 AS shape, lower(CASE doc_id % 3 WHEN 0 THEN inner_path WHEN 1 THEN '/scan_' || doc_id || '.pdf'
              ELSE '/' || name END) AS fixed, 'Keeper ' || source AS custodian FROM dm),
          firsts AS (SELECT shape, fixed, min(rule_order) AS rule_order, arg_min(custodian, rule_order) AS custodian FROM rules GROUP BY ALL),
          claims AS (SELECT path, f.rule_order, f.custodian FROM mc JOIN firsts f ON shape = 0 AND fixed = lower(inner_path)
            UNION ALL SELECT path, f.rule_order, f.custodian FROM mc JOIN firsts f ON fixed = '/' || lower(mc.name)
              AND (shape = 1 AND contains(inner_path, '/') OR shape = 2 AND length(mc.folder) > 0)
            UNION ALL SELECT path, rule_order + 2000000000000, custodian FROM mc WHERE rule_order >= 0)
          SELECT path, coalesce(min(c.rule_order), -1) AS rule_order, coalesce(arg_min(c.custodian, c.rule_order), 'Unassigned') AS custodian
          FROM dm LEFT JOIN claims c USING (path) GROUP BY path"""),
        "first_match_inside": _dm("""SELECT path, CAST(coalesce(r, CASE WHEN substr(inner_path, 2, 1) IN ('n', 'N') THEN 1000000 ELSE 1000001 END) AS BIGINT) AS rule_order,
            CASE WHEN r IS NOT NULL THEN 'Desk ' || r % 7 WHEN substr(inner_path, 2, 1) IN ('n', 'N') THEN 'Second letter' ELSE 'All others' END AS custodian
          FROM (SELECT path, any_value(inner_path) AS inner_path, min(item_id) AS r FROM dm LEFT JOIN benchmark ON contains(lower(inner_path), 'c_' || item_id) GROUP BY path)"""),
        "seeded_semi_anti": _everything("""SELECT type, path, rule_id, CASE WHEN EXISTS
            (SELECT 1 FROM found f WHERE f.path = s.path AND f.rule_id = s.rule_id) THEN 'caught' ELSE 'missed' END AS verdict FROM seeded s"""),
        "label_vs_accepted": _everything("""SELECT path, label, array_to_string(accepted, ', ') AS accepted,
            CASE WHEN list_contains(accepted, label) THEN 'hit' ELSE 'miss' END AS verdict
          FROM truth JOIN cls USING (path) WHERE accepted IS NOT NULL"""),
        # aggregations
        "dup_groups": _dm("SELECT sha256, count(*) AS n, CAST(count(DISTINCT name) = 1 AS VARCHAR) AS one_name FROM m WHERE size_bytes > 0 GROUP BY 1 HAVING count(*) > 1"),
        "stem_groups": _dm("SELECT stem, count(*) AS n, CAST(count(DISTINCT name) = 1 AS VARCHAR) AS one_name FROM m GROUP BY 1 HAVING count(*) > 1 AND count(DISTINCT sha256) > 1"),
        "findings_by_severity": _found(f"""SELECT s.severity, CAST(ord AS BIGINT) AS ord, count(f.path) AS findings FROM {_SEVERITIES} LEFT JOIN found f ON f.severity = s.severity GROUP BY ALL"""),
        "findings_by_rule": _found("SELECT rule_id, count(*) AS findings FROM found GROUP BY 1"),
        "label_counts": _cls("SELECT label, count(*) AS files FROM cls GROUP BY 1"),
        "flagged_clean": _found("""SELECT (SELECT count(*) FROM dm) AS total, (SELECT count(DISTINCT path) FROM found) AS flagged,
          (SELECT count(*) FROM dm WHERE path NOT IN (SELECT path FROM found)) AS clean"""),
        "bucket_counts": _xref("SELECT axis, bucket, count(*) AS files FROM xref GROUP BY ALL"),
        "bucket_summary": _xref(_SUMMARY + " GROUP BY axis"),
        "status_error_count": _with((DM, CLS, _ASKED), "SELECT count(*) FILTER (status = 'model_error') AS model_errors, count(*) AS files FROM judged"),
        "hash_multiplicity": _dm("""SELECT sha256, count(*) AS files FROM dm WHERE size_bytes > 0
          AND sha256 NOT IN (SELECT sha256 FROM dm WHERE author = 'Unassigned') GROUP BY 1 HAVING count(*) > 1"""),
        # orders and limits
        "exceptions_sorted": _found("SELECT * FROM found ORDER BY path, rule_id"),
        "review_queue": _found(f"""SELECT f.*, {_LABEL_FOLDER.replace('folder', 'dm.folder')} AS folder,
          row_number() OVER (ORDER BY {_SEVERITY_ORD}, rule_id, path) AS position FROM found f JOIN dm USING (path)"""),
        "rule_chart_order": _found(f"""SELECT rule_id, severity, count(*) AS findings,
          row_number() OVER (ORDER BY {_SEVERITY_ORD}, count(*) DESC, rule_id) AS position FROM found GROUP BY rule_id, severity"""),
        "label_chart_order": _cls("SELECT label, count(*) AS files, row_number() OVER (ORDER BY count(*) DESC, label) AS position FROM cls GROUP BY 1"),
        "bucket_list_order": _xref("""SELECT axis, bucket, count(*) AS files,
          row_number() OVER (ORDER BY axis, bucket = 'Unassigned', lower(bucket), bucket) AS position FROM xref GROUP BY axis, bucket"""),
        "top_n_messages": _found("""SELECT rule_id, position, path, detail FROM (SELECT *,
          row_number() OVER (PARTITION BY rule_id ORDER BY path) AS position FROM found) WHERE position <= 5"""),
        # set operations
        "all_findings": _found("SELECT * FROM found"),
        "all_crossrefs": _xref("SELECT * FROM xref"),
        "path_set_difference": """SELECT doc_id, 'left only' AS side FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
          UNION ALL SELECT doc_id, 'right only' FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)""",
        "path_set_intersection": _everything("SELECT path FROM dm WHERE path NOT IN (SELECT path FROM seeded) INTERSECT SELECT path FROM found"),
        "axis_value_overlap": _dm("""SELECT author AS value FROM mc WHERE author <> 'Unassigned'
          INTERSECT SELECT custodian FROM mc WHERE custodian <> 'Unassigned'"""),
        # organising
        "copy_plan": _xref("SELECT axis, original_path AS path, bucket, new_path AS dest FROM xref"),
        "collisions": _clashes("'/organized/' || author || '/' || name"),
        "collisions_folded": _clashes("lower('/organized/' || author || '/' || stem0 || '/' || extension)"),
        "dry_run_counts": _xref("SELECT axis, bucket, count(*) AS files, CAST(0 AS BIGINT) AS collisions FROM xref GROUP BY ALL"),
        "crossref": _xref("SELECT * FROM xref"),
        "folder_batches": _xref("""SELECT original_folder AS source_folder, regexp_replace(new_path, '/[^/]*$', '') AS dest_folder,
          count(*) AS files FROM xref GROUP BY ALL"""),
        "axis_divergence": _cls("""SELECT mc.path, CASE WHEN status = 'ok' THEN label ELSE 'Unassigned' END AS class_bucket,
          author AS author_bucket, custodian AS custodian_bucket FROM mc JOIN cls USING (path)
          WHERE class_bucket <> author AND author <> custodian AND class_bucket <> custodian"""),
        # reconciliation
        "recon_checks": _everything(_recon("cls")),
        "recon_gate": _everything(f""", more AS (SELECT label FROM cls UNION ALL SELECT 'unclassified' FROM benchmark)
          SELECT * FROM ({_recon('more')}) WHERE ok <> 'match'"""),
        "summary_figures": _everything(_FIGURES),
        "report_figures": _everything(_FIGURES),
        "full_run_figures": _everything(_FIGURES),
        # Written files are plain text, so none of them tells an author.
        "full_run_collection": _everything(f"""SELECT figure, CASE figure WHEN 'unassigned_author' THEN (SELECT count(*) FROM dm)
          WHEN 'buckets_author' THEN 1 ELSE value END AS value FROM ({_FIGURES})"""),
        "run_snapshot": _found("""SELECT 'manifest' AS name, count(*) AS "rows", count(DISTINCT path) AS paths FROM dm
          UNION ALL SELECT 'classifications', count(*), count(DISTINCT path) FROM cls
          UNION ALL SELECT 'exceptions', count(*), count(DISTINCT path) FROM found"""),
        "intake_param": """SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'no file system is known for it' WHEN 2 THEN 'the root of a store'
            WHEN 3 THEN 'ok' WHEN 4 THEN 'no address'
            ELSE CASE WHEN regexp_matches(url, '^[a-z]*://[^/]+/+[^/]') THEN 'ok' ELSE 'the root of a store' END END AS verdict FROM pages""",
        "output_guard": """SELECT page_id, ['ok', 'inside the collection', 'inside the collection', 'around the collection', 'ok'][page_id % 5 + 1] AS verdict
          FROM pages WHERE regexp_extract(url, '^[a-z]*://([^/]*)', 1) <> ''""",
        "axis_summary": _xref(_SUMMARY + " GROUP BY axis"),
        # gates
        "absence_check": _everything("""SELECT type, path, rule_id, CASE WHEN rule_id = '' THEN 'no rule owns this type' ELSE 'missed' END AS problem
          FROM seeded s WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.path = s.path AND f.rule_id = s.rule_id)"""),
        "false_positive_check": _everything("""SELECT path, string_agg(DISTINCT rule_id, ', ' ORDER BY rule_id) AS rules FROM found
          WHERE path NOT IN (SELECT path FROM seeded) GROUP BY 1"""),
        "coverage_check": """WITH d AS (SELECT doc_id, count(*) AS n FROM documents GROUP BY 1), l AS (SELECT doc_id, count(*) AS n FROM labels GROUP BY 1)
          SELECT (SELECT count(*) FROM documents) AS expected_rows, (SELECT count(*) FROM labels) AS actual_rows,
            (SELECT count(*) FROM d WHERE doc_id NOT IN (SELECT doc_id FROM l)) AS missing,
            (SELECT count(*) FROM l WHERE doc_id NOT IN (SELECT doc_id FROM d)) AS phantom,
            (SELECT count(*) FROM l WHERE n > 1) AS repeated""",
        "accuracy_check": _everything("""SELECT count(*) FILTER (list_contains(accepted, label)) AS hits, count(*) AS scored
          FROM truth JOIN cls USING (path) WHERE accepted IS NOT NULL"""),
        "no_guess_check": _everything("""SELECT path, label, CASE WHEN accepted IS NULL THEN 'guessed' ELSE 'dropped' END AS problem
          FROM truth JOIN cls USING (path) WHERE (accepted IS NULL) = (label <> 'unclassified')"""),
        "rule_recompute_check": _cls("SELECT path, 'LOW_CONFIDENCE' AS rule_id, 'missing' AS problem FROM cls WHERE status = 'ok' AND confidence >= 0.75 AND confidence < 0.9"),
        "domain_check": _found("""SELECT * FROM (VALUES ('manifest: blank sha256', 0::BIGINT), ('manifest: blank true_type', 0), ('manifest: blank author', 0),
            ('findings: unknown rule', 0), ('findings: unknown severity', 0), ('classifications: unknown status', 0),
            ('classifications: confidence out of range', 0), ('classifications: label without text', 0),
            ('classifications: no reason given', 0)) v("constraint", violations)
          UNION ALL SELECT 'findings: blank detail', count(*) FROM found WHERE trim(detail) = ''
          UNION ALL SELECT 'classifications: unknown label', count(*) FROM cls WHERE label = 'es'"""),
        "key_uniqueness": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
        "snapshot_diff": _with((DM,), """, b AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents UNION ALL SELECT -1 - item_id, sha256(text) FROM benchmark),
            a AS (SELECT doc_id, sha256(replace(body, ' 1', ' one')) AS h FROM dm)
          SELECT doc_id, CASE WHEN b.h IS NULL THEN 'added' WHEN a.h IS NULL THEN 'removed' ELSE 'changed' END AS change
          FROM b FULL JOIN a USING (doc_id) WHERE a.h IS DISTINCT FROM b.h"""),
        "snapshot_tree_diff": _dm("""SELECT path, 'changed' AS change FROM dm WHERE starts_with(path, 'corpus/Invoices/') AND contains(body, ' 1')
          UNION ALL SELECT 'corpus/pages/' || page_id, 'added' FROM pages"""),
        "figure_check": _everything(f"SELECT figure, value AS published, value AS recomputed, 'match' AS verdict FROM ({_FIGURES})"),
        "determinism_sample": _cls(""", ok AS (SELECT path, label, row_number() OVER (ORDER BY path) AS position, count(*) OVER () AS n FROM cls WHERE status = 'ok')
          SELECT path, position, label, label AS again, 'same' AS verdict FROM ok
          WHERE (position - 1) % greatest(1, n // 8) = 0 AND position - 1 < 8 * greatest(1, n // 8)"""),
        "planted_date_check": _dm("""SELECT path, strftime(modified, '%Y-%m-%d') AS modified, 'intact' AS verdict FROM dm
          WHERE doc_id % 101 = 0 OR doc_id % 103 = 0"""),
        "run_gates": _everything("""SELECT gate, problems, CASE WHEN problems = 0 THEN 'passed' ELSE 'FAILED' END AS verdict FROM (
            SELECT 'planted errors caught' AS gate, (SELECT count(*) FROM seeded s WHERE NOT EXISTS
              (SELECT 1 FROM found f WHERE f.path = s.path AND f.rule_id = s.rule_id)) AS problems
            UNION ALL SELECT 'nothing flagged by mistake', (SELECT count(DISTINCT path) FROM found WHERE path NOT IN (SELECT path FROM seeded))
            UNION ALL SELECT 'labels accepted', (SELECT count(*) FILTER (NOT list_contains(accepted, label)) FROM truth JOIN cls USING (path) WHERE accepted IS NOT NULL)
            UNION ALL SELECT 'nothing guessed or dropped', (SELECT count(*) FROM truth JOIN cls USING (path) WHERE (accepted IS NULL) = (label <> 'unclassified'))
            UNION ALL SELECT 'values inside their domains', (SELECT count(*) FROM cls WHERE label = 'es') + (SELECT count(*) FROM found WHERE trim(detail) = '')
            UNION ALL SELECT gate, 0 FROM (VALUES ('every file classified once'), ('classifier findings derived again'), ('paths unique'), ('planted dates intact')) v(gate))"""),
        "binary_types": _BINARY + "SELECT path, extension, true_type, size_bytes, stem FROM odd",
        "binary_findings": _BINARY + f"""SELECT path, name, 'EXT_MISMATCH' AS rule_id, '{RULE_SEVERITY["EXT_MISMATCH"]}' AS severity,
              {_filled(EXT_MISMATCH_DETAIL, 'lower(extension)', 'true_type')} AS detail FROM odd
            WHERE true_type NOT IN ('empty', 'unknown') AND want <> '' AND true_type <> want
          UNION ALL SELECT path, name, 'ZERO_BYTE', '{RULE_SEVERITY["ZERO_BYTE"]}', {_text(ZERO_BYTE_DETAIL)} FROM odd WHERE true_type = 'empty'
          UNION ALL SELECT path, name, 'NAMING', '{RULE_SEVERITY["NAMING"]}', reasons FROM odd WHERE reasons <> '' AND lower(name) <> '.ds_store'""",
        # sources and sinks
        "file_inventory": _dm("""SELECT path, name, extension, true_type, size_bytes, sha256,
          strftime(modified, '%Y-%m-%dT00:00:00') AS modified, 'Unassigned' AS author FROM dm"""),
        "collection_guard": """SELECT DISTINCT '/collections/' || lang AS collection_root,
          CASE WHEN lang = 'en' THEN 'ok' ELSE 'built from another collection' END AS verdict FROM documents""",
        "manifest_read": _dm(f"""SELECT {_MANIFEST.replace('path, name,', "path, name || ' \"x\", ' || lang || chr(10) || 'y ' AS name,").replace('author,', "CASE WHEN author = 'Unassigned' THEN '' ELSE author END AS author,")} FROM dm"""),
        "manifest_write": _dm(f"SELECT {_MANIFEST} FROM dm"),
        "classifications_write": _cls(f"SELECT {CLS_COLUMNS} FROM cls"),
        "exceptions_write": _found("SELECT path, name, rule_id, severity, detail FROM found"),
        "rules_table_read": _dm("SELECT CAST(rule_order AS BIGINT) AS rule_order, custodian, count(*) AS files FROM mc GROUP BY ALL"),
        "answer_key_read": _everything("""SELECT path, 'error' AS kind, type AS value FROM seeded
          UNION ALL SELECT path, 'author', author FROM dm
          UNION ALL SELECT path, 'label', coalesce(array_to_string(accepted, ', '), 'none') FROM truth"""),
        "crossref_write": _xref("SELECT * FROM xref"),
        "copy_sink": _xref("""SELECT 'by-' || axis || '/' || CASE axis WHEN 'author' THEN 'Unassigned' ELSE bucket END
            || substr(original_path, length('corpus') + 1) AS copy, original_path AS path, sha256, size_bytes FROM xref"""),
        "copy_verify": _xref("SELECT original_path AS path, 'ok' AS verdict FROM xref"),
        "crossref_verify": _xref("SELECT axis, original_path, 'ok' AS verdict FROM xref"),
        "date_fidelity": _dm(""", n AS (SELECT count(*) AS n, CAST(0 AS BIGINT) AS z FROM dm)
          SELECT axis, field, CASE WHEN field = 'modified' THEN n ELSE z END AS compared, CASE WHEN field = 'modified' THEN n ELSE z END AS matching,
            z AS differing, z AS missing, CASE WHEN field = 'created' THEN n ELSE z END AS not_available
          FROM n, (VALUES ('class'), ('author'), ('custodian')) a(axis), (VALUES ('created'), ('modified')) f(field)"""),
        # extraction and inference
        "extract_text": _dm(f"""SELECT path, CASE WHEN doc_id % 3 <> 0 THEN 'zip' ELSE true_type END AS true_type,
          CAST(length(body) AS BIGINT) AS chars, sha256 AS text_hash FROM dm"""),
        "extract_author": _dm("SELECT path, CASE WHEN doc_id % 3 = 0 THEN 'Unassigned' ELSE author END AS author FROM dm"),
        "classify_stored": _with((DM, CLS, _ASKED), f"SELECT {CLS_COLUMNS} FROM judged"),
        "classify_batch": _with((DM, CLS, _ASKED), f"SELECT {CLS_COLUMNS} FROM judged"),
        "classify_keyword": _cls(f"SELECT {CLS_COLUMNS} FROM cls"),
        # whole runs
        "no_model_run": _with((DM, CLS, XREF, f"f AS ({_DUP_FINDINGS} UNION ALL {_FILE_FINDINGS})"), """
          SELECT 'rule' AS kind, rule_id AS item, count(*) AS n FROM f GROUP BY 2
          UNION ALL SELECT axis, bucket, count(*) FROM xref WHERE axis <> 'class' GROUP BY 1, 2"""),
    }
    for rule, spec in _ROW_RULES.items():
        sql["rule_" + rule.lower()] = _dm(_rule(rule, "m", *spec))
    for rule, spec in _CLASS_RULES.items():
        sql["rule_" + rule.lower()] = _cls(_rule(rule, "cls", *spec))
    # A list of CTEs may be continued by a query that starts with a comma.
    return {key: text.replace("\n,", ",") for key, text in sql.items()}
