"""DuckDB SQL that computes, from the same parquet tables, what each registered query returns."""

from __future__ import annotations

from claimlake.plans import fixtures as fx
from claimlake.plans.tables import TERMS_BUCKET

RUN = f"'{fx.RUN_TS}'"
MEASURES = "character_length, utf8_byte_length, exceeds_redshift_varchar_65535_bytes"
BRONZE_COLS = f"id, terms, {MEASURES}, _ingestion_timestamp, _source_file"
# Messages, statuses and patterns are spelled out here, not taken from the engine, so that a slip
# there can't match itself. White space: the characters that Python's ``str.strip`` removes.
WS_CODES = (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
WS = " || ".join(f"chr({c})" for c in WS_CODES)
PAT = "'^s3://([^/]+)/(.+)$'"
NOT_BLANK = "(terms IS NOT NULL AND length(trim(terms)) > 0)"
DEFAULT_OK = "(id IS NOT NULL AND terms IS NOT NULL)"


NO_LIMIT = 2**62


WITH = f"WITH f1 AS ({fx.SQL_F1}), bronze AS ({fx.SQL_BRONZE})"
SILVER = f"SELECT {BRONZE_COLS}, {RUN} AS _silver_processed_at FROM bronze WHERE {DEFAULT_OK}"
ANNOTATED3 = f"""
SELECT id, terms, _dq_not_null_id, _dq_not_null_terms, _dq_not_empty_terms,
       _dq_not_null_id AND _dq_not_null_terms AND _dq_not_empty_terms AS _dq_passed,
       concat_ws(',', CASE WHEN NOT _dq_not_null_id THEN '_dq_not_null_id' END,
                      CASE WHEN NOT _dq_not_null_terms THEN '_dq_not_null_terms' END,
                      CASE WHEN NOT _dq_not_empty_terms THEN '_dq_not_empty_terms' END) AS _dq_failed_checks
FROM (SELECT id, terms, id IS NOT NULL AS _dq_not_null_id, terms IS NOT NULL AS _dq_not_null_terms,
             {NOT_BLANK} AS _dq_not_empty_terms FROM {{src}}) a
"""


def _resolved(max_bytes: int | None, src: str, ptr: str, key_cols: str) -> str:
    """Resolve semantics over pointers ``ptr`` of ``src`` with the store ``st`` in scope."""
    max_bytes = NO_LIMIT if max_bytes is None else max_bytes
    lim = f"{max_bytes:,}"
    return f"""
p AS (SELECT {key_cols}, {ptr} AS __u,
             regexp_extract(trim({ptr}, {WS}), {PAT}, 1) AS __b,
             regexp_extract(trim({ptr}, {WS}), {PAT}, 2) AS __k FROM {src}),
j AS (SELECT p.*, st.key AS __sk, st.text AS __t, st.n_bytes AS __sn, st.bad AS __bad
      FROM p LEFT JOIN st ON p.__b = '{TERMS_BUCKET}' AND p.__k <> '' AND p.__k = st.key),
s AS (SELECT *, CASE WHEN __u IS NULL OR __u = '' THEN 'missing_pointer'
                     WHEN __b = '' THEN 'malformed'
                     WHEN __b <> '{TERMS_BUCKET}' THEN 'no_store'
                     WHEN __sk IS NULL THEN 'not_found'
                     WHEN __sn > {max_bytes} THEN 'too_large'
                     WHEN __bad THEN 'undecodable' ELSE 'ok' END AS status FROM j),
r AS (SELECT *, CASE WHEN status = 'ok' THEN __t END AS full_text,
             CASE status WHEN 'missing_pointer' THEN 'No pointer in this row - there is no text to fetch.'
                         WHEN 'malformed' THEN 'Pointer ''' || __u || ''' is not of the form s3://bucket/key.'
                         WHEN 'no_store' THEN 'Bucket ''' || __b || ''' is not a known text store.'
                         WHEN 'not_found' THEN 'The store holds nothing under this key.'
                         WHEN 'too_large' THEN 'Text too large to return inline (' || format('{{:,}}', __sn)
                                                    || ' bytes, limit {lim} bytes).'
                         WHEN 'undecodable' THEN 'The stored object is not UTF-8 text.' END AS message,
             CAST(__sn AS BIGINT) AS n_bytes FROM s)
"""


RESOLVE_WHOLE = f"""
WITH ptr AS ({fx.SQL_POINTERS}), st AS ({fx.SQL_STORE}),
{_resolved(None, "ptr", "u", "doc_id, u")}
"""
RESOLVE_FIXTURE = f"""
WITH ptr AS ({fx.SQL_POINTERS}), st AS ({fx.SQL_STORE}),
{_resolved(fx.STORE_MAX_BYTES, "ptr", "u", "doc_id, u")}
"""

# Store built by the pipeline: one object per bronze row with id and text.
GOLD_STORE = f"""st AS (SELECT 'terms/' || id || '.txt' AS key, _raw_terms AS text,
                       strlen(_raw_terms) AS n_bytes, false AS bad
                FROM bronze WHERE id IS NOT NULL AND _raw_terms IS NOT NULL),
gold AS ({SILVER})"""

ORACLE: dict[str, str] = {
    "scan_landing_csv": f"{WITH} SELECT id, terms, {MEASURES} FROM f1",
    "scan_landing_recursive": f"{WITH} SELECT id, terms, _dir AS _source_dir FROM f1",
    "scan_landing_suffix": f"{WITH} SELECT id, terms, 'csv' AS _source_suffix FROM f1",
    "scan_landing_headers": f"""{WITH} SELECT id, terms,
        CASE WHEN doc_id % 4 <> 2 THEN character_length END AS character_length,
        CASE WHEN doc_id % 4 <> 2 THEN utf8_byte_length END AS utf8_byte_length,
        CASE WHEN doc_id % 4 <> 2 THEN exceeds_redshift_varchar_65535_bytes END AS exceeds_redshift_varchar_65535_bytes,
        CASE WHEN doc_id % 4 = 3 THEN 'n' END AS note FROM f1""",
    "scan_landing_ragged": f"""{WITH}
        SELECT id, terms, {MEASURES}, _ingestion_timestamp, NULL AS _raw_line, NULL AS _dq_failed_checks
        FROM bronze WHERE doc_id % 10 NOT IN (3, 7)
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, {RUN},
               CASE WHEN doc_id % 10 = 3 THEN {fx.sql_cell("id")} ELSE {" || ',' || ".join(map(fx.sql_cell, fx.HEADERS[0]))} || ',"more"' END,
               'ragged_row'
        FROM f1 WHERE doc_id % 10 IN (3, 7)""",
    "scan_bronze_table": f"{WITH} SELECT {BRONZE_COLS} FROM bronze",
    "write_bronze": f"{WITH} SELECT {BRONZE_COLS} FROM bronze",
    "source_to_bronze": f"{WITH} SELECT {BRONZE_COLS} FROM bronze",
    "offload_text": f"""{WITH} SELECT '{TERMS_BUCKET}' AS bucket, 'terms/' || id || '.txt' AS key,
        _raw_terms AS text, CAST(strlen(_raw_terms) AS BIGINT) AS n_bytes
        FROM bronze WHERE id IS NOT NULL AND _raw_terms IS NOT NULL""",
    "scan_text_objects": f"""{WITH} SELECT '{TERMS_BUCKET}' AS bucket, 'terms/' || id || '.txt' AS key,
        _raw_terms AS text, CAST(strlen(_raw_terms) AS BIGINT) AS n_bytes
        FROM bronze WHERE id IS NOT NULL AND _raw_terms IS NOT NULL""",
    "replace_with_pointer": f"{WITH} SELECT id, terms FROM bronze",
    "measure_text": f"{WITH} SELECT id, terms, {MEASURES} FROM f1",
    "stamp_ingestion": f"{WITH} SELECT id, _ingestion_timestamp FROM bronze",
    "stamp_source_file": f"{WITH} SELECT id, _source_file FROM bronze",
    "write_silver": f"{WITH} {SILVER}",
    "publish_gold": f"{WITH} {SILVER}",
    "medallion_end_to_end": f"{WITH} {SILVER}",
    "stream_pipeline": f"{WITH} {SILVER}",
    "write_quarantine": f"""{WITH} SELECT {BRONZE_COLS},
        id IS NOT NULL AS _dq_not_null_id, terms IS NOT NULL AS _dq_not_null_terms, false AS _dq_passed,
        concat_ws(',', CASE WHEN id IS NULL THEN '_dq_not_null_id' END,
                       CASE WHEN terms IS NULL THEN '_dq_not_null_terms' END) AS _dq_failed_checks,
        {RUN} AS _silver_processed_at
        FROM bronze WHERE NOT {DEFAULT_OK}""",
    "stamp_silver": f"{WITH} SELECT id, {RUN} AS _silver_processed_at FROM bronze WHERE {DEFAULT_OK}",
    "drop_check_columns": f"""{WITH} SELECT {BRONZE_COLS}, {RUN} AS _silver_processed_at
        FROM bronze WHERE id IS NOT NULL AND terms IS NOT NULL AND {NOT_BLANK}""",
    "bronze_to_silver": f"""{WITH}, a AS ({ANNOTATED3.format(src="bronze")})
        SELECT id, terms, CASE WHEN _dq_passed THEN 'silver' ELSE 'quarantine' END AS _layer,
               CASE WHEN _dq_passed THEN NULL ELSE _dq_failed_checks END AS _dq_failed_checks FROM a""",
    "filter_id_in": f"{WITH} SELECT * FROM ({SILVER}) g WHERE id IN ('1', '2', '3')",
    "preview_limit": f"{WITH} SELECT * FROM ({SILVER}) g ORDER BY id LIMIT 10",
    "split_complete": f"""{WITH} SELECT count(*) AS n_bronze,
        count(*) FILTER (WHERE {DEFAULT_OK}) AS n_silver,
        count(*) FILTER (WHERE NOT {DEFAULT_OK}) AS n_quarantine FROM bronze""",
    "quarantine_summary": f"""{WITH}, c AS (
        SELECT '_dq_not_null_id' AS check_name, count(*) FILTER (WHERE id IS NULL) AS n_rows FROM bronze
        UNION ALL SELECT '_dq_not_null_terms', count(*) FILTER (WHERE terms IS NULL) FROM bronze
        UNION ALL SELECT '_dq_not_empty_terms', count(*) FILTER (WHERE NOT {NOT_BLANK}) FROM bronze)
        SELECT check_name, n_rows FROM c WHERE n_rows > 0""",
    "predicate_not_null": f"""{WITH} SELECT id, terms, id IS NOT NULL AS id_not_null,
        terms IS NOT NULL AS terms_not_null FROM f1""",
    "predicate_not_blank": f"{WITH} SELECT id, terms, {NOT_BLANK} AS terms_not_blank FROM f1",
    "check_not_null": f"""{WITH} SELECT id, terms, id IS NOT NULL AS _dq_not_null_id,
        terms IS NOT NULL AS _dq_not_null_terms FROM bronze""",
    "check_not_empty": f"{WITH} SELECT id, terms, {NOT_BLANK} AS _dq_not_empty_terms FROM f1",
    "check_extension": f"""{WITH}, c AS (
        SELECT id, terms, strlen(terms) <= {fx.STORE_MAX_BYTES} AND id IS NOT NULL AS _dq_max_bytes_terms FROM f1)
        SELECT id, terms, _dq_max_bytes_terms, coalesce(_dq_max_bytes_terms, false) AS _dq_passed,
        CASE WHEN coalesce(_dq_max_bytes_terms, false) THEN '' ELSE '_dq_max_bytes_terms' END AS _dq_failed_checks
        FROM c""",
    "check_unique": f"""
        SELECT id, terms, _dq_unique_id, id IS NOT NULL AS _dq_not_null_id, _dq_unique_id AND id IS NOT NULL AS _dq_passed,
               concat_ws(',', CASE WHEN NOT _dq_unique_id THEN '_dq_unique_id' END,
                              CASE WHEN id IS NULL THEN '_dq_not_null_id' END) AS _dq_failed_checks
        FROM (SELECT *, id IS NULL OR count(*) OVER (PARTITION BY id) = 1 AS _dq_unique_id FROM ({fx.SQL_REPEATED_IDS}) r) u""",
    "annotate_checks": f"{WITH} {ANNOTATED3.format(src='f1')}",
    "dq_passed": f"{WITH} SELECT id, terms, _dq_passed FROM ({ANNOTATED3.format(src='f1')}) a",
    "dq_failed_names": f"{WITH} SELECT id, terms, _dq_failed_checks FROM ({ANNOTATED3.format(src='f1')}) a",
    "dq_no_checks": f"{WITH} SELECT id, terms, true AS _dq_passed, '' AS _dq_failed_checks FROM f1",
    "filter_passed": f"{WITH} SELECT id, terms FROM f1 WHERE id IS NOT NULL AND {NOT_BLANK}",
    "filter_failed": f"""{WITH} SELECT id, terms, _dq_failed_checks FROM ({ANNOTATED3.format(src='f1')}) a
        WHERE NOT _dq_passed""",
    "parse_uri": f"""WITH ptr AS ({fx.SQL_POINTERS}) SELECT doc_id, u,
        regexp_extract(trim(u, {WS}), {PAT}, 1) AS bucket,
        regexp_extract(trim(u, {WS}), {PAT}, 2) AS key FROM ptr""",
    "resolve_text": f"{RESOLVE_WHOLE} SELECT doc_id, u, status, full_text, message, n_bytes FROM r",
    "resolve_status": f"{RESOLVE_FIXTURE} SELECT status, count(*) AS n_rows FROM r GROUP BY status",
    "resolve_row_cap": f"""WITH ptr AS ({fx.SQL_POINTERS}) SELECT doc_id, u, 'too_many' AS status,
        CAST(NULL AS VARCHAR) AS full_text, 'More than 100 rows asked for inline text - resolve at most 100 rows, or use the bulk path.' AS message FROM ptr""",
    "resolve_few": f"""{WITH}, {GOLD_STORE}, g AS (SELECT * FROM gold WHERE id IN ('1', '2', '3')),
        {_resolved(None, "g", "terms", "id, terms")}
        SELECT id, terms, status, full_text, message, n_bytes FROM r""",
    "resolve_bulk": f"""{WITH}, {GOLD_STORE},
        {_resolved(None, "gold", "terms", "id, terms")}
        SELECT id, terms, status, full_text, message, n_bytes FROM r""",
    "stream_arrivals": f"{WITH} SELECT id, terms, {MEASURES}, _dir AS _source_dir FROM f1",
    "resolve_files": f"{RESOLVE_WHOLE} SELECT doc_id, u, status, full_text, message, n_bytes FROM r",
    "resolve_file_errors": f"""{RESOLVE_WHOLE}, e AS (
        SELECT *, CASE WHEN status NOT IN ('ok', 'undecodable') THEN status WHEN doc_id % 3 = 0 THEN 'access_denied'
                       WHEN doc_id % 5 = 0 THEN 'error:EIO' ELSE status END AS seen FROM r)
        SELECT doc_id, u, seen AS status, CASE WHEN seen = 'ok' THEN full_text END AS full_text,
               CASE seen WHEN 'access_denied' THEN 'The store refused to hand out this object.'
                         WHEN 'error:EIO' THEN 'Could not read the stored object (EIO).' ELSE message END AS message, n_bytes FROM e""",
    "resolve_hot": f"""SELECT 's3://{TERMS_BUCKET}/' || p.key AS u, p.n_rows, 'ok' AS status, s.text AS full_text,
        CAST(strlen(s.text) AS BIGINT) AS n_bytes
        FROM (SELECT {fx.SQL_FOLDED_KEY} AS key, count(*) AS n_rows FROM documents GROUP BY 1) p
        JOIN ({fx.SQL_REPEATED}) s ON s.key = p.key AND s.bucket = '{TERMS_BUCKET}'""",
    "get_text_sql": f"""{WITH}, {GOLD_STORE},
        {_resolved(None, "gold", "terms", "id, terms")}
        SELECT id, terms, coalesce(full_text, message) AS full_text FROM r""",
    "get_text_sql_few": f"""{WITH}, {GOLD_STORE}, g AS (SELECT * FROM gold WHERE id IN ('1', '2', '3')),
        {_resolved(None, "g", "terms", "id, terms")}
        SELECT id, terms, coalesce(full_text, message) AS full_text FROM r""",
    "offload_duplicates": f"SELECT bucket, key, text, CAST(strlen(text) AS BIGINT) AS n_bytes FROM ({fx.SQL_REPEATED}) s",
    "resolve_two_buckets": f"""SELECT 's3://' || bucket || '/' || key AS u, 'ok' AS status, text AS full_text,
        CAST(strlen(text) AS BIGINT) AS n_bytes FROM ({fx.SQL_REPEATED}) s""",
}

ORACLE["silver_rules_path"] = ORACLE["bronze_to_silver"]
