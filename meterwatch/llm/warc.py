"""Not-modified revisits: an as-of join by canonical URL to the latest earlier full response.

Captures are ordered within (URL, time chunk), so that a URL with a great share of all captures is spread over many tasks.
A revisit without a response in its chunk takes the last one before the chunk, which comes from one row for each URL and
chunk. Only validators, digests and headers take part; bodies stay where they are.
Bound: the captures of one URL within one chunk of `CHUNK` seconds, or of one time, sort in one task, however many they are.
Results stay right; only that task takes longer.

A revisit's entity tag must equal the response's (weak marks aside); without a tag its modification time must; without
both it is accepted as unchecked. A resolved record has the response's digest and headers, where the headers that a 304
may update (`PERMITTED`) replace the old ones. Of captures at one time a response isn't earlier than a revisit; of
responses at one time the greatest id is the latest.

Defined cases: a revisit without URL or time never resolves (`orphan`) and takes no part in the ordering; a response without
URL or time is no one's earlier response; null `full` is a revisit; null headers count as none, and of headers whose names differ
in case alone the greatest value counts; repeated rows are resolved each; an empty table gives an empty table; columns other than
those of `CAPTURE` are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from meterwatch.llm.common import let

CAPTURE = ("record_id", "url", "ts", "full", "etag", "modified", "digest", "headers")
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Seconds of a chunk of captures that are ordered together.
CHUNK = 6 * 3600
#: Steps to a canonical URL without its scheme: pattern and replacement, in this order; $1 is the first group.
CANONICAL = (
    (r"#.*$", ""),
    (r"([?&])(?:utm_[a-z]+|ref)=[^&]*", "$1"),
    (r"&&+", "&"),
    (r"\?&+", "?"),
    (r"[?&]+$", ""),
    (r"^[a-zA-Z]+://", ""),
    (r"/+$", ""),
)


def canonical(url: str) -> str:
    """SQL for the canonical form of a URL: host in lower case, without scheme, www, default port, fragment, tracking.

    The default port is that of the scheme: 443 for https, 80 for all others and without a scheme.
    """
    port = f"if({url} ILIKE 'https://%', ':443$', ':80$')"
    for pattern, to in CANONICAL:
        url = f"regexp_replace({url}, r'{pattern}', '{to}')"
    host = f"regexp_extract({url}, '^[^/?]*', 0)"
    return f"concat(regexp_replace(regexp_replace(lower({host}), '^www[.]', ''), {port}, ''), substr({url}, length({host}) + 1))"


def _lower_keys(headers: str) -> str:
    """SQL: a map with its keys in lower case; of equal ones the greatest value counts, and null is the empty map."""
    entries = f"array_sort(transform(map_entries(coalesce({headers}, map())), e -> struct(lower(e.key) AS key, e.value AS value)))"
    return let(entries, "es", "map_from_entries(filter(es, (e, i) -> NOT exists(slice(es, i + 2, size(es)), f -> f.key = e.key)))")


def captures_of(pages: DataFrame) -> DataFrame:
    """Derive captures from pages: a full response of each, and for two thirds a revisit a day later, some of them with a
    changed tag, some with a modification time alone, some without validators."""
    tag = "concat('\"', substr(md5(html), 1, 16), '\"')"
    return pages.selectExpr(
        "url", "html", "page_id", f"{tag} AS tag", "page_id * 60 AS t", "explode(if(page_id % 3 = 0, array(0), array(0, 1))) AS visit"
    ).selectExpr(
        "page_id * 2 + visit AS record_id", "url", "t + visit * 86400 AS ts", "visit = 0 AS full",
        "CASE WHEN visit = 0 THEN tag WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '\"changed\"' ELSE concat('W/', tag) END AS etag",
        "if(visit = 0 OR page_id % 10 = 0, t, NULL) AS modified", "if(visit = 0, md5(html), NULL) AS digest",
        "if(visit = 0, map('content-type', 'text/html', 'date', cast(t AS string), 'server', 'a'), "
        "map('cache-control', 'max-age=60', 'date', cast(t + 86400 AS string), 'set-cookie', 'x')) AS headers",
    )


def resolve(captures: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """record_id, url (canonical), ts, response_id, outcome, digest and headers of every revisit."""
    permitted = ", ".join(f"'{h}'" for h in PERMITTED)
    return captures.sparkSession.sql(
        f"""
        WITH held AS (
          SELECT record_id, url, ts, full, etag, modified, digest, headers, floor(ts / {chunk}) AS chunk,
            if(full, struct(ts, record_id, etag, modified, digest), NULL) AS r, if(full, headers, NULL) AS rh
          FROM (SELECT record_id, {canonical('url')} AS url, ts, coalesce(full, false) AS full, etag, modified, digest,
                  {_lower_keys('headers')} AS headers FROM {{captures}})),
        ordered AS (
          SELECT *, last_value(r) IGNORE NULLS OVER w AS inside, last_value(rh) IGNORE NULLS OVER w AS inside_headers
          FROM held WHERE url IS NOT NULL AND ts IS NOT NULL
          WINDOW w AS (PARTITION BY url, chunk ORDER BY ts, full, record_id, etag, modified, digest ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        heads AS (SELECT url, chunk, max(r) AS r, max_by(rh, r) AS rh FROM held WHERE url IS NOT NULL AND ts IS NOT NULL GROUP BY url, chunk),
        before AS (
          SELECT url, chunk, last_value(r) IGNORE NULLS OVER w AS r, last_value(rh) IGNORE NULLS OVER w AS rh FROM heads
          WINDOW w AS (PARTITION BY url ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        found AS (
          SELECT o.record_id, o.url, o.ts, o.etag, o.modified, o.headers, coalesce(o.inside, b.r) AS r,
            if(o.inside IS NOT NULL, o.inside_headers, b.rh) AS rh
          FROM ordered o LEFT JOIN before b ON b.url = o.url AND b.chunk = o.chunk WHERE NOT o.full
          UNION ALL
          SELECT record_id, url, ts, etag, modified, headers, NULL, NULL FROM held WHERE NOT full AND (url IS NULL OR ts IS NULL)),
        judged AS (
          SELECT *, CASE WHEN r IS NULL THEN 'orphan'
            WHEN etag IS NOT NULL THEN if(regexp_replace(etag, '^W/', '') = regexp_replace(coalesce(r.etag, ''), '^W/', ''), 'resolved', 'mismatch')
            WHEN modified IS NOT NULL THEN if(modified <=> r.modified, 'resolved', 'mismatch') ELSE 'unchecked' END AS outcome FROM found)
        SELECT record_id, url, ts, r.record_id AS response_id, outcome, if(outcome IN ('resolved', 'unchecked'), r.digest, NULL) AS digest,
          if(outcome IN ('resolved', 'unchecked'), array_join(transform(array_sort(map_entries(map_concat(
            map_filter(rh, (k, v) -> NOT (k IN ({permitted}) AND map_contains_key(headers, k))),
            map_filter(headers, (k, v) -> k IN ({permitted}))))), e -> concat(e.key, '=', e.value)), ';'), NULL) AS headers
        FROM judged
        """,
        captures=captures,
    )


def digest(pages: DataFrame) -> DataFrame:
    return resolve(captures_of(pages))


#: The query on plain windows over whole URLs, for DuckDB. URLs are taken apart by splitting, not by the patterns above.
ORACLE = f"""
    WITH bare AS (SELECT *, split_part(url, '#', 1) AS b FROM pages),
    parts AS (SELECT *, CASE WHEN regexp_matches(b, '^[A-Za-z]+://') THEN lower(split_part(b, '://', 1)) ELSE '' END AS scheme,
        CASE WHEN regexp_matches(b, '^[A-Za-z]+://') THEN substr(b, strpos(b, '://') + 3) ELSE b END AS rest FROM bare),
    cut AS (SELECT *, split_part(rest, '?', 1) AS place, string_split(substr(rest, strlen(split_part(rest, '?', 1)) + 2), '&') AS params FROM parts),
    named AS (SELECT *, lower(split_part(place, '/', 1)) AS host, substr(place, strlen(split_part(place, '/', 1)) + 1) AS path,
        list_filter(params, lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref)=')) AS kept FROM cut),
    plain AS (SELECT *, CASE WHEN starts_with(host, 'www.') THEN substr(host, 5) ELSE host END AS h FROM named),
    urls AS (SELECT page_id, html, rtrim(CASE WHEN scheme = 'https' AND ends_with(h, ':443') THEN left(h, -4)
          WHEN scheme <> 'https' AND ends_with(h, ':80') THEN left(h, -3) ELSE h END || path
          || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END, '/') AS u FROM plain),
    visits AS (SELECT *, unnest(CASE WHEN page_id % 3 = 0 THEN [0] ELSE [0, 1] END) AS visit,
        '"' || substr(md5(html), 1, 16) || '"' AS tag FROM urls),
    held AS (SELECT page_id * 2 + visit AS record_id, u AS url, page_id * 60 + visit * 86400 AS ts, visit = 0 AS is_full, page_id,
        CASE WHEN visit = 0 THEN tag WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '"changed"' ELSE tag END AS etag,
        CASE WHEN visit = 0 OR page_id % 10 = 0 THEN page_id * 60 END AS modified,
        CASE WHEN visit = 0 THEN {{'id': page_id * 2, 'tag': tag, 't': page_id * 60, 'h': md5(html)}} END AS r FROM visits),
    found AS (SELECT *, last_value(r IGNORE NULLS) OVER (PARTITION BY url ORDER BY ts, is_full, record_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM held),
    judged AS (SELECT *, CASE WHEN p IS NULL THEN 'orphan' WHEN etag IS NOT NULL THEN CASE WHEN etag = p.tag THEN 'resolved' ELSE 'mismatch' END
        WHEN modified IS NOT NULL THEN CASE WHEN modified = p.t THEN 'resolved' ELSE 'mismatch' END ELSE 'unchecked' END AS outcome
      FROM found WHERE NOT is_full)
    SELECT record_id, url, ts, p.id AS response_id, outcome, CASE WHEN outcome IN ('resolved', 'unchecked') THEN p.h END AS digest,
      CASE WHEN outcome IN ('resolved', 'unchecked') THEN 'cache-control=max-age=60;content-type=text/html;date='
        || CAST(page_id * 60 + 86400 AS VARCHAR) || ';server=a' END AS headers FROM judged"""
