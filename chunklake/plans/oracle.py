"""The same results in plain SQL, for DuckDB over the same tables. Cuts follow next-pointers in a recursive query."""

from __future__ import annotations

from chunklake.functions.options import DEFAULT_CLIP_MS
from chunklake.plans.fixtures import FOLDER_LINES
from chunklake.plans.queries import CLIP_MS, IDLE_MS, LONG_CLIP_MS, NOW, SRC

_CHUNKS = """
chunks AS (
  SELECT CASE WHEN (event_id // 640) % 3 = 0 THEN 'hot' ELSE 'cam' || ((event_id // 64) % 29) END AS session_id,
         event_id AS line_no, 'data' AS kind,
         event_id + event_id // 997 AS sequence,
         event_id + (event_id // 4096) * 8386560 + ((event_id % 4096) * (event_id % 4096 - 1)) // 2
           + (event_id // 1009) * 7 AS "offset",
         1 + event_id % 4096 AS length,
         epoch_us(ts) // 1000 - CASE WHEN event_id % 13 = 5 THEN 7200000 ELSE 0 END AS ts_ms,
         epoch_us(ts) // 1000 AS arrival_ms
  FROM events)"""

_LINES = f"""{_CHUNKS},
texts AS (
  SELECT *, '{{"kind":"data","sequence":' || sequence || ',"offset":' || "offset" || ',"length":' || length
            || ',"ts_ms":' || ts_ms || '}}' AS text FROM chunks),
lines AS (
  SELECT session_id, line_no, kind, sequence, "offset", length, ts_ms, line_no % 50 AS slot,
         CASE line_no % 50 WHEN 7 THEN replace(text, '"data"', '"json"')
                           WHEN 11 THEN replace(text, '"sequence"', '"seq"')
                           WHEN 13 THEN substr(text, 1, 30)
                           WHEN 17 THEN replace(text, '"offset":', '"offset":-')
                           WHEN 19 THEN '' ELSE text END AS line
  FROM texts),
parsed AS (
  SELECT session_id, line_no, line, nullif(regexp_extract(line, '"kind":"([^"]*)"', 1), '') AS kind,
         TRY_CAST(regexp_extract(line, '"sequence":(-?[0-9]+)', 1) AS BIGINT) AS sequence,
         TRY_CAST(regexp_extract(line, '"offset":(-?[0-9]+)', 1) AS BIGINT) AS "offset",
         TRY_CAST(regexp_extract(line, '"length":(-?[0-9]+)', 1) AS BIGINT) AS length,
         TRY_CAST(regexp_extract(line, '"ts_ms":(-?[0-9]+)', 1) AS BIGINT) AS ts_ms
  FROM (SELECT * REPLACE (replace(line, '"offset":-0,', '"offset":0,') AS line) FROM lines)),
metas AS (
  SELECT *, kind IS NOT NULL AND sequence >= 0 AND "offset" >= 0 AND length >= 0 AND ts_ms IS NOT NULL AS whole FROM parsed),
records AS (
  SELECT session_id, line_no, kind, sequence, "offset", length, ts_ms FROM metas WHERE whole AND kind = 'data')"""


def _cut(chunks: str, idle_ms: int | None = None, clip_ms: int = CLIP_MS, name: str = "session_id") -> str:
    """From a CTE named ``chunks`` to one named ``clips``, with the session's ``name``."""
    pause = f" OR arrival_ms - lag(arrival_ms) OVER w >= {idle_ms}" if idle_ms else ""
    return f"""{chunks},
flagged AS (
  SELECT *, CASE WHEN lag(sequence) OVER w IS NULL THEN 1
                 WHEN sequence <> lag(sequence) OVER w + 1
                   OR "offset" <> lag("offset") OVER w + lag(length) OVER w{pause} THEN 1 ELSE 0 END AS fresh
  FROM chunks WINDOW w AS (PARTITION BY session_id ORDER BY line_no)),
islands AS (
  SELECT *, sum(fresh) OVER (PARTITION BY session_id ORDER BY line_no) AS island FROM flagged),
runs AS (
  SELECT *, max(ts_ms) OVER (PARTITION BY session_id, island ORDER BY line_no) AS high FROM islands),
pointers AS (
  SELECT *, min(line_no) OVER (PARTITION BY session_id, island ORDER BY high
                               RANGE BETWEEN {clip_ms} FOLLOWING AND UNBOUNDED FOLLOWING) AS next_line FROM runs),
starts AS (
  SELECT session_id, island, line_no, next_line FROM pointers WHERE fresh = 1
  UNION ALL
  SELECT p.session_id, p.island, p.line_no, p.next_line
  FROM starts s JOIN pointers p ON p.session_id = s.session_id AND p.line_no = s.next_line),
numbered AS (
  SELECT r.session_id, r.island, r.line_no, r.ts_ms, r."offset", r.length,
         sum(CASE WHEN s.line_no IS NULL THEN 0 ELSE 1 END)
           OVER (PARTITION BY r.session_id ORDER BY r.line_no) AS clip_no
  FROM runs r LEFT JOIN starts s ON s.session_id = r.session_id AND s.line_no = r.line_no),
grouped AS (
  SELECT session_id, clip_no, min(island) AS island, arg_min(ts_ms, line_no) AS start_ts_ms,
         arg_min("offset", line_no) AS "offset", sum(length) AS length
  FROM numbered GROUP BY session_id, clip_no),
clips AS (
  SELECT 'clip' AS type, {name} AS session_id, clip_no, CAST(start_ts_ms // 1000 AS BIGINT) AS ts,
         '{SRC}/' || {name} || '_' || (start_ts_ms // 1000) || '.bin' AS path,
         CAST("offset" AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length,
         coalesce(lead(island) OVER (PARTITION BY session_id ORDER BY clip_no) = island, true) AS complete
  FROM grouped)"""


_CLIPS = f'WITH RECURSIVE {_cut(_CHUNKS)} SELECT type, session_id, ts, path, "offset", length, complete FROM clips'
_CLIPS_IDLE = (
    f'WITH RECURSIVE {_cut(_CHUNKS, IDLE_MS)} SELECT type, session_id, ts, path, "offset", length, complete FROM clips'
)
_LINE_CHUNKS = f"""{_LINES.replace("chunks AS", "all_chunks AS").replace("FROM chunks", "FROM all_chunks")},
chunks AS (SELECT * FROM records)"""

# the same in files: a session of each folder, so many lines, is one of its own
_FILE_CHUNKS = _LINE_CHUNKS.replace("(SELECT * FROM records)", f"""(
  SELECT * REPLACE (session_id || '@' || (line_no // {FOLDER_LINES}) AS session_id) FROM records)""")
_FILE_SESSION = "split_part(session_id, '@', 1)"

_EVENT_JSON = """
plain AS (
  SELECT event_id, user_id, event_type, props,
         to_json({type: event_type, user_id: user_id, event_id: event_id, props: props}) :: VARCHAR AS whole
  FROM events),
texts AS (
  SELECT event_id, user_id, event_type, props,
         CASE event_id % 40 WHEN 3 THEN ' ' || chr(9) || whole || '  '
                            WHEN 9 THEN substr(whole, 1, length(whole) - 1) ELSE whole END AS raw FROM plain),
trimmed AS (SELECT event_id, user_id, event_type, props, trim(raw, ' ' || chr(9)) AS line, event_id % 40 = 9 AS cut FROM texts)"""

_STORE = """
store AS (
  SELECT concat_ws(':', event_type, user_id) AS key, CAST(event_id AS VARCHAR) AS value,
         CASE WHEN event_id % 5 = 0 THEN 0 ELSE event_id % 2000 END AS expire_at, ts, event_id FROM events),
latest AS (
  SELECT key, arg_max(value, event_id) AS value, CAST(arg_max(expire_at, event_id) AS BIGINT) AS expire_at
  FROM store GROUP BY key)"""

def _rounds(*runs: int) -> str:
    """Runs of the same rows with keys of several users in one; run 0 is the rows as they are, called 1."""
    writes = " UNION ALL ".join(
        f"""SELECT {max(run, 1)} AS run, event_type || ':' || (user_id // {max(run, 1)}) AS key, '{f"{run}-" if run else ""}' || event_id AS value,
         CASE WHEN event_id % 5 = 0 THEN 0 ELSE event_id % 2000 END AS expire_at, event_id FROM events"""
        for run in runs
    )
    return f"""writes AS ({writes}),
latest AS (
  SELECT key, arg_max(value, run * 100000000000 + event_id) AS value,
         CAST(arg_max(expire_at, run * 100000000000 + event_id) AS BIGINT) AS expire_at FROM writes GROUP BY key)"""


_CLIP_RECORDS = """
records AS (
  SELECT event_id, 'u' || user_id AS session_id, epoch_us(ts) // 1000000 AS seconds,
         '/clips/' || event_id || '.mp4' AS path, event_id % 11 = 6 AS lacks_path, event_id % 9 = 4 AS quoted
  FROM events)"""

_URL = "'^(https?)://([^/]+)(/[^?]*)'"
_URL_MATCH = f"""
SELECT page_id, regexp_extract(url, {_URL}, 1) AS scheme, regexp_extract(url, {_URL}, 2) AS host,
       regexp_extract(url, {_URL}, 3) AS path
FROM pages WHERE regexp_matches(url, {_URL})"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = "'^([A-Z][a-z]+) ([A-Za-z]+)'"


def _csv(column: str) -> str:
    quoted = f"""'"' || replace({column}, '"', '""') || '"'"""
    return f"CASE WHEN regexp_matches({column}, '[,\"\\r\\n]') THEN {quoted} ELSE {column} END"


_FROM_FILES = f"""WITH RECURSIVE {_cut(_FILE_CHUNKS, clip_ms=DEFAULT_CLIP_MS, name=_FILE_SESSION)}
SELECT session_id || ':' || ts AS key, arg_max(path, clip_no) AS value, CAST({NOW + 300} AS BIGINT) AS expire_at
FROM clips GROUP BY ALL"""

ORACLES: dict[str, str] = {
    "clip_cut": _CLIPS,
    "clip_cut_blocks": _CLIPS,
    "clip_cut_idle": _CLIPS_IDLE,
    "clip_cut_from_lines": f'WITH RECURSIVE {_cut(_LINE_CHUNKS)} '
    'SELECT type, session_id, ts, path, "offset", length, complete FROM clips',
    "clip_jsonl": f"""WITH RECURSIVE {_cut(_CHUNKS)}
SELECT '{{"type":"clip","session_id":"' || session_id || '","ts":' || ts || ',"path":"' || path || '","offset":'
       || "offset" || ',"length":' || length || ',"complete":' || complete || '}}' AS line FROM clips""",
    "clip_file_lines": f"""WITH RECURSIVE {_cut(_CHUNKS)}
SELECT session_id, CAST(ts AS VARCHAR) AS ts, path FROM clips""",
    "continuity_breaks": f"""WITH {_CHUNKS},
pairs AS (
  SELECT session_id, line_no, sequence, lag(sequence) OVER w + 1 AS expected_sequence, "offset",
         lag("offset") OVER w + lag(length) OVER w AS expected_offset
  FROM chunks WINDOW w AS (PARTITION BY session_id ORDER BY line_no))
SELECT session_id, line_no, sequence, expected_sequence, "offset", expected_offset FROM pairs
WHERE sequence <> expected_sequence OR "offset" <> expected_offset""",
    "sidecar_parse": f"""WITH {_LINES}
SELECT session_id, line_no AS line_id, kind, sequence, "offset", length, ts_ms FROM records""",
    "sidecar_parse_json": f"""WITH {_LINES}
SELECT session_id, line_no AS line_id, kind, sequence, "offset", length, ts_ms FROM records""",
    "sidecar_rejects": f"""WITH {_LINES}
SELECT line_no AS line_id, CASE WHEN whole THEN 'not a data record' ELSE 'malformed record' END AS reason, lines.line
FROM lines JOIN metas USING (line_no) WHERE lines.line <> '' AND NOT coalesce(whole AND metas.kind = 'data', false)""",
    "meta_structs": f"""WITH {_LINES}
SELECT line_no AS line_id, CASE WHEN whole THEN kind END AS kind,
       CASE WHEN whole THEN sequence END AS sequence, CASE WHEN whole THEN "offset" END AS "offset",
       CASE WHEN whole THEN length END AS length, CASE WHEN whole THEN ts_ms END AS ts_ms
FROM metas""",
    "log_regex_extract": _URL_MATCH,
    "log_regex_filter": f"{_URL_MATCH} AND regexp_extract(url, {_URL}, 1) = 'https'",
    "log_regex_unknown_key": f"SELECT *, 'scheme' AS key FROM ({_URL_MATCH}) WHERE scheme = 'https'",
    "log_regex_words": f"""
SELECT doc_id, regexp_extract(line, {_WORDS}, 1) AS a, regexp_extract(line, {_WORDS}, 2) AS b
FROM (SELECT doc_id, trim(text, {_BLANKS}) AS line FROM documents) WHERE regexp_matches(line, {_WORDS})""",
    "log_regex_optional": """
SELECT page_id, regexp_extract(url, '^https?://(m\\.|blog\\.)([a-z]+)', 1) AS prefix,
       regexp_extract(url, '^https?://(m\\.|blog\\.)([a-z]+)', 2) AS name
FROM pages WHERE regexp_matches(url, '^https?://(m\\.|blog\\.)([a-z]+)')""",
    "log_rejects": f"""
SELECT 'line did not match regex' AS reason, line
FROM (SELECT trim(text, {_BLANKS}) AS line FROM documents) WHERE NOT regexp_matches(line, {_WORDS})""",
    "log_file_lines": f"WITH {_EVENT_JSON} SELECT line FROM trimmed",
    "json_kv_filter": f"WITH {_EVENT_JSON} SELECT event_id, line FROM trimmed WHERE NOT cut AND event_type = 'click'",
    "json_kv_filter_scalar": f"WITH {_EVENT_JSON} SELECT event_id, line FROM trimmed WHERE NOT cut AND user_id = 8",
    "json_kv_number_no_match": f"""WITH {_EVENT_JSON}
SELECT event_id, replace(line, '"user_id":8,', '"user_id":"8",') AS line FROM trimmed WHERE NOT cut AND line LIKE '%"user_id":8,%'""",
    "json_passthrough": f"WITH {_EVENT_JSON} SELECT event_id, line FROM trimmed WHERE NOT cut",
    "json_rejects": f"WITH {_EVENT_JSON} SELECT 'malformed JSON line' AS reason, line FROM trimmed WHERE cut",
    "to_jsonl": """
SELECT to_json({doc_id: CAST(doc_id AS VARCHAR), text: text, lang: lang}) :: VARCHAR AS line FROM documents""",
    "to_csv_lines": f"""
SELECT CAST(doc_id AS VARCHAR) || ',' || {_csv('text')} || ',' || {_csv('lang')} AS line FROM documents""",
    "trimmed_lines": f"SELECT conv_id, turn, trim(text, {_BLANKS}) AS line FROM conversations",
    "textual_fields": f"""WITH {_EVENT_JSON}
SELECT event_id, event_type AS type_string, CAST(NULL AS VARCHAR) AS user_string, CAST(user_id AS VARCHAR) AS user_scalar,
       props AS props_string, event_id AS event_integer, NOT cut AS is_object FROM trimmed""",
    "marker_sessions": "SELECT page_id, url || '/.pipeline_end' AS path FROM pages WHERE page_id % 7 = 0",
    "ended_sessions": """WITH hosts AS (SELECT page_id, regexp_extract(url, '://([^/]+)', 1) AS host FROM pages)
SELECT '/in/' || host AS folder, 'p' || page_id AS session_id FROM hosts
WHERE host IN (SELECT host FROM hosts WHERE page_id % 7 = 0)""",
    "missing_payload": """
SELECT CAST(doc_id AS VARCHAR) AS session_id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "store_rows": f"""WITH {_CLIP_RECORDS}
SELECT session_id || ':' || seconds AS key, path AS value, CAST({NOW + 300} AS BIGINT) AS expire_at
FROM records WHERE NOT lacks_path""",
    "store_rows_no_ttl": f"""WITH {_CLIP_RECORDS}
SELECT session_id || ':' || seconds AS key, path AS value, CAST(0 AS BIGINT) AS expire_at
FROM records WHERE NOT lacks_path""",
    "store_rejects": f"""WITH {_CLIP_RECORDS}
SELECT event_id AS line_id, 'malformed clip JSON' AS reason,
       '{{"type":"clip","session_id":"' || session_id || '","ts":'
       || CASE WHEN quoted THEN '"' || seconds || '"' ELSE CAST(seconds AS VARCHAR) END || '}}' AS line
FROM records WHERE lacks_path""",
    "store_latest": f"WITH {_STORE} SELECT key, value, expire_at FROM latest",
    "store_lookup": f"WITH {_STORE} SELECT key, value FROM latest WHERE key = 'click:8'",
    "store_lookup_many": f"""WITH {_STORE}
SELECT key, value FROM latest WHERE (expire_at = 0 OR expire_at > {NOW})
  AND key IN (SELECT 'view:' || c_custkey FROM customer)""",
    "store_compact": f"WITH {_STORE} SELECT key, value, expire_at FROM latest WHERE expire_at = 0 OR expire_at > {NOW}",
    "store_live_rows": f"""WITH {_STORE}
SELECT key, value, CAST(expire_at AS BIGINT) AS expire_at FROM store WHERE expire_at = 0 OR expire_at > {NOW}""",
    "store_text_lines": f"WITH {_STORE} SELECT key || chr(9) || value || chr(9) || expire_at AS line FROM store",
    "store_append_read": f"""WITH {_STORE},
writes AS (
  SELECT 1 AS run, key, value, expire_at, event_id FROM store
  UNION ALL SELECT 2, key, 'new-' || value, expire_at, event_id FROM store WHERE event_id % 3 = 0)
SELECT key, arg_max(value, run * 1000000000 + event_id) AS value,
       CAST(arg_max(expire_at, run * 1000000000 + event_id) AS BIGINT) AS expire_at FROM writes GROUP BY key""",
    "store_snapshot": f"WITH {_STORE} SELECT key, value, expire_at FROM latest WHERE expire_at = 0 OR expire_at > {NOW}",
    "store_append_during_compaction": f"""WITH {_rounds(0, 2)}
SELECT key, value, expire_at FROM latest WHERE expire_at = 0 OR expire_at > {NOW}""",
    "store_merge_rounds": f"""WITH {_rounds(1, 2, 3)}
SELECT key, value, expire_at FROM latest WHERE expire_at = 0 OR expire_at > {NOW}""",
    "store_index_lookup": f"""WITH {_rounds(0, 2, 3, 4)}
SELECT key, value FROM latest WHERE (expire_at = 0 OR expire_at > {NOW}) AND key IN (SELECT 'view:' || c_custkey FROM customer)""",
    "store_bucketed_latest": f"""WITH {_rounds(1, 2)} SELECT key, value, expire_at FROM latest""",
    "store_bucketed_lookup": f"""WITH {_rounds(1, 2)}
SELECT key, value FROM latest WHERE (expire_at = 0 OR expire_at > {NOW}) AND key IN (SELECT 'view:' || c_custkey FROM customer)""",
    "store_import_tsv": f"""WITH {_STORE}
SELECT key, value, CAST(expire_at AS BIGINT) AS expire_at FROM store WHERE key <> 'error:8'""",
    "pipeline_end_to_end": f"""WITH RECURSIVE {_cut(_CHUNKS, clip_ms=DEFAULT_CLIP_MS)}
SELECT session_id || ':' || ts AS key, arg_max(path, clip_no) AS value, CAST({NOW + 300} AS BIGINT) AS expire_at
FROM clips GROUP BY ALL""",
    "stream_clip_cut": _CLIPS,
    "stream_log_extract": _URL_MATCH,
    "stream_json_filter": """
SELECT event_id, to_json({type: event_type, user_id: user_id, event_id: event_id, props: props}) :: VARCHAR AS line
FROM events WHERE event_type = 'click'""",
    "stream_store": f"""
SELECT 'u' || user_id || ':' || (event_id % 10) AS key,
       '/clips/' || max(event_id) || '.mp4' AS value, CAST({NOW + 300} AS BIGINT) AS expire_at
FROM events GROUP BY user_id, event_id % 10""",
    "clip_cut_long_span": f"""WITH RECURSIVE {_cut(_CHUNKS.replace("chunks AS", "all_chunks AS") + """,
chunks AS (
  SELECT session_id, line_no, nth AS sequence, nth * 5 AS "offset", 5 AS length, ts_ms, arrival_ms
  FROM (SELECT *, CASE WHEN session_id = 'hot' THEN line_no // 1920 * 640 + line_no % 640 ELSE line_no // 1856 * 64 + line_no % 64 END AS nth
        FROM all_chunks))""", clip_ms=LONG_CLIP_MS)}
SELECT type, session_id, ts, path, "offset", length, complete FROM clips""",
    "stream_clip_cut_idle": _CLIPS_IDLE,
    "store_stream_after_snapshot": f"""WITH {_STORE},
streamed AS (
  SELECT p || user_id || ':' || (event_id % 10) AS key, '/' || p || '/' || max(event_id) || '.mp4' AS value
  FROM events, (VALUES ('a'), ('b')) prefixes(p) GROUP BY p, user_id, event_id % 10)
SELECT key, value, expire_at FROM latest WHERE expire_at = 0 OR expire_at > {NOW}
UNION ALL SELECT key, value, CAST({NOW + 300} AS BIGINT) FROM streamed""",
    "store_batch_then_stream": f"""
WITH old AS (SELECT DISTINCT 'u' || user_id || ':' || (event_id % 12) AS key FROM events),
fresh AS (
  SELECT 'u' || user_id || ':' || (event_id % 10) AS key, '/u/' || max(event_id) || '.mp4' AS value
  FROM events GROUP BY ALL HAVING true)
SELECT key, coalesce(fresh.value, '/old.mp4') AS value, CAST(CASE WHEN fresh.key IS NULL THEN 0 ELSE {NOW + 300} END AS BIGINT) AS expire_at
FROM old FULL JOIN fresh USING (key)""",
    "sidecar_file_scan": f"""WITH {_LINES}
SELECT session_id, line FROM (
  SELECT *, session_id LIKE 'cam%3' AS torn, lead(line_no) OVER (PARTITION BY session_id, line_no // {FOLDER_LINES} ORDER BY line_no) IS NULL AS last
  FROM lines WHERE session_id NOT LIKE 'cam%3' OR line LIKE '%}}')
WHERE line <> '' AND NOT (torn AND last)""",
    "sidecar_files_two_folders": " UNION ALL ".join(
        f"""SELECT * FROM (WITH RECURSIVE {_cut(_FILE_CHUNKS.replace("FROM records)", f"FROM records WHERE line_no >= {least})"), name=_FILE_SESSION)}
SELECT type, session_id, ts, path, "offset", length, complete FROM clips)"""
        for least in (0, 500)
    ),
    "pipeline_from_files": _FROM_FILES,
    "pipeline_stream_from_files": _FROM_FILES,
    "pipeline_stream_in_segments": f"""SELECT * FROM ({_FROM_FILES}) UNION ALL
SELECT * FROM (WITH {_LINES}
SELECT CASE WHEN whole THEN 'not a data record' ELSE 'malformed record' END AS key, lines.line AS value, CAST(-1 AS BIGINT) AS expire_at
FROM lines JOIN metas USING (line_no) WHERE lines.line <> '' AND NOT coalesce(whole AND metas.kind = 'data', false))""",
    "stream_growing_lines": f"""WITH {_LINES}
SELECT 'r' || (line_no // {FOLDER_LINES}) AS folder, session_id, line FROM lines""",
    "stream_folder_markers": f"""WITH RECURSIVE {_cut(_FILE_CHUNKS, name=_FILE_SESSION)}
SELECT type, session_id, ts, path, "offset", length, complete FROM clips""",
    "stream_clip_cut_segments": _CLIPS,
    "stream_lookup_table": f"WITH {_STORE} SELECT key, value, expire_at FROM latest WHERE expire_at = 0 OR expire_at > {NOW}",
    "log_regex_nested": """
SELECT page_id, regexp_extract(url, p, 1) AS prefix, regexp_extract(url, p, 2) AS kind, regexp_extract(url, p, 3) AS name,
       regexp_extract(url, p, 4) AS label, regexp_extract(url, p, 5) AS "end"
FROM (SELECT *, '^https?://((m|blog)[.])([a-z]+)[.](example)[.](com|(net))/([a-z]*)' AS p FROM pages) WHERE regexp_matches(url, p)""",
    "nested_fields": """
SELECT event_id, regexp_extract(line, '"k"[ ]*:[ ]*([^,} ]+)', 1) AS k_scalar, 'say "k": 9 \\ ok' AS note_string,
       CAST(regexp_extract(line, '"event_id" : ([0-9]+)', 1) AS BIGINT) AS event_integer
FROM (SELECT event_id, '{"note":"say \\"k\\": 9 \\\\ ok","props":' || props || ',"k":"later","event_id" : ' || event_id || '}' AS line FROM events)""",
}
