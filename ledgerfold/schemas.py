"""Explicit schemas; nothing is inferred when a table is read back."""

MANIFEST = (
    "path STRING, name STRING, extension STRING, true_type STRING, "
    "size_bytes BIGINT, sha256 STRING, created TIMESTAMP_NTZ, "
    "modified TIMESTAMP_NTZ, author STRING, collection_root STRING"
)
CLASSIFICATIONS = (
    "path STRING, name STRING, chars BIGINT, label STRING, confidence DOUBLE, "
    "folder_hint STRING, status STRING, reason STRING"
)
FINDINGS = "path STRING, name STRING, rule_id STRING, severity STRING, detail STRING"
CROSSREF = (
    "original_path STRING, original_folder STRING, bucket STRING, new_path STRING, "
    "sha256 STRING, size_bytes BIGINT, created TIMESTAMP_NTZ, modified TIMESTAMP_NTZ"
)
RULES_TABLE = "rule_order INT, pattern STRING, custodian STRING, source_note STRING"
ANSWER_KEY = (
    "generated STRING, file_count INT, files ARRAY<STRING>, "
    "seeded_errors ARRAY<STRUCT<type: STRING, paths: ARRAY<STRING>, note: STRING>>, "
    "authors MAP<STRING, STRING>, classes MAP<STRING, ARRAY<STRING>>"
)

MANIFEST_COLUMNS = [part.split()[0] for part in MANIFEST.split(", ")]
CLASSIFICATION_COLUMNS = [part.split()[0] for part in CLASSIFICATIONS.split(", ")]
FINDING_COLUMNS = [part.split()[0] for part in FINDINGS.split(", ")]
CROSSREF_COLUMNS = [part.split()[0] for part in CROSSREF.split(", ")]
