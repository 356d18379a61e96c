"""DuckDB oracles for the HTTP-log and work-list queries."""

from __future__ import annotations

from .oracle import with_

HTTP_LOG = """log AS (
  SELECT event_id seq, user_id probe, concat(
    '{''request'': {''type'': ', CASE WHEN event_id%10=0 THEN 'HEAD' ELSE 'GET' END,
    ', ''headers'': {User-Agent=''x/1''',
    CASE WHEN event_id%10=0 THEN '' ELSE concat(', Range=''bytes=', event_id::varchar, '-', (event_id+999)::varchar, '''') END,
    '}}, ''response'': {''status'': ', CASE WHEN event_id%10=0 THEN 'OK_200' ELSE 'PartialContent_206' END,
    ', ''headers'': {Content-Length=''', CASE WHEN event_id%10=0 THEN '47673370' ELSE (1000+(event_id*7919)%60000)::varchar END, '''',
    CASE WHEN event_id%10=0 THEN '' ELSE concat(', Content-Range=''bytes ', event_id::varchar, '-', (event_id+999)::varchar, '/47673370''') END,
    '}}}') message
  FROM events)"""

PARSED = r"""parsed AS (
  SELECT seq, probe,
    coalesce(nullif(regexp_extract(message, '''type'':\s*(\w+)', 1), ''), '?') method,
    coalesce(nullif(regexp_extract(message, '''status'':\s*(\w+)', 1), ''), '?') status,
    nullif(regexp_extract(message, 'Range=''?bytes=([0-9\-]+)', 1), '') range_header,
    nullif(regexp_extract(message, 'Content-Length=''?(\d+)', 1), '')::BIGINT content_length,
    nullif(regexp_extract(message, 'Content-Range=''?bytes [0-9\-]+/(\d+)', 1), '')::BIGINT total_size
  FROM log)"""

HTTP_PARSE = with_(HTTP_LOG, PARSED) + "SELECT * FROM parsed"

_FULL = ("coalesce(arg_min(content_length, seq) FILTER (WHERE method = 'HEAD' AND content_length > 0), "
         "max(total_size) FILTER (WHERE total_size > 0))")
_GET_BYTES = "coalesce(sum(CASE WHEN method = 'GET' THEN coalesce(content_length, 0) END), 0)::BIGINT"

TRANSFER_SUMMARY = with_(HTTP_LOG, PARSED) + f"""
SELECT probe, count(*) AS n_requests, count_if(method = 'GET') AS n_get, {_GET_BYTES} AS get_bytes,
  {_FULL} AS full_size, CASE WHEN {_FULL} > 0 THEN {_GET_BYTES}::DOUBLE / {_FULL} END AS fraction
FROM parsed GROUP BY probe"""

FETCH_WORKLIST = r"""WITH named AS (
  SELECT page_id, url,
    regexp_extract(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '([^/]+)/*$', 1) AS name
  FROM pages),
done AS (SELECT name FROM named WHERE page_id % 3 = 0 GROUP BY name HAVING max(CASE WHEN page_id % 6 = 0 THEN 0 ELSE 1 END) > 0)
SELECT page_id, url, name FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY page_id) rn FROM named)
WHERE rn = 1 AND name NOT IN (SELECT name FROM done)"""

ORACLES = {
    "http_parse": HTTP_PARSE,
    "transfer_summary": TRANSFER_SUMMARY,
    "fetch_worklist": FETCH_WORKLIST,
}
