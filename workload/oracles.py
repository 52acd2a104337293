"""The same results as plain SQL over the supplied tables, written for DuckDB."""

_SITE = "https://site.example"
_RUN_TS = "TIMESTAMP '2030-01-01 00:00:00'"

_REGISTRY = """
registry AS (
  SELECT CAST(page_id AS VARCHAR) AS id, url,
         CASE WHEN url LIKE 'https:%' THEN true WHEN url LIKE '%?%' THEN NULL ELSE false END AS is_active,
         TIMESTAMP '2024-01-31 00:00:00' AS last_crawled_at
  FROM pages
)"""

_HISTORY = """
history AS (
  SELECT event_id AS id, CAST(user_id AS VARCHAR) AS page_id, ts AS scrape_timestamp,
         strftime(ts, '%d/%m/%Y') AS modified_date,
         CASE WHEN event_type = 'error' THEN 'Not Found' ELSE event_type END AS updated_by,
         props AS responsible, props AS full_modified_text
  FROM events
),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY scrape_timestamp DESC, id DESC) AS rn
    FROM history) WHERE rn = 1
)"""

_STATUS = """
status AS (
  SELECT p.id AS page_id, p.url, p.is_active, p.last_crawled_at,
         h.scrape_timestamp AS last_scrape_timestamp, h.modified_date AS last_modified_date,
         h.updated_by AS last_updated_by, h.responsible AS last_responsible,
         h.full_modified_text AS last_full_modified_text
  FROM registry p LEFT JOIN latest h ON p.id = h.page_id
  WHERE p.is_active = true
)"""

# Link names of each page, and the same names as a browser writes them in a URL.
_NAMES = """
names AS (
  SELECT page_id, url, html, regexp_extract_all(html, '<a href="/([^"]*)"', 1) AS names FROM pages
),
encoded AS (
  SELECT *, list_transform(names, lambda w: array_to_string(list_transform(string_split(w, ''),
    lambda c: CASE WHEN regexp_full_match(c, '[!#-;=?-_a-~]') THEN c ELSE url_encode(c) END), '')) AS enc
  FROM names
)"""

_SITE_LINKS = f"""{_NAMES},
fetched AS (
  SELECT page_id,
         CASE WHEN page_id = 0 THEN '{_SITE}/#!' ELSE '{_SITE}/#!/' || enc[2] END AS src_url,
         list_transform(enc, lambda w: '{_SITE}/#!/' || w) AS targets
  FROM encoded
),
newest AS (
  SELECT src_url, targets FROM (
    SELECT *, row_number() OVER (PARTITION BY src_url ORDER BY page_id DESC) AS rn FROM fetched)
  WHERE rn = 1
),
site_links AS (
  SELECT src_url, CAST(unnest(range(len(targets))) AS INTEGER) AS position, unnest(targets) AS dst_url
  FROM newest
)"""

_VISITED = f"""{_SITE_LINKS},
visited(url, depth) USING KEY (url) AS (
  SELECT '{_SITE}/#!', 0
  UNION
  SELECT DISTINCT l.dst_url, v.depth + 1
  FROM visited v JOIN site_links l ON l.src_url = v.url
  WHERE l.dst_url NOT IN (SELECT url FROM recurring.visited)
)"""

_EMITTED = (
    "SELECT replace(trim(split_part(url, '#!/', 2), '/'), '/', '_') AS id, url, depth FROM visited "
    "WHERE split_part(url, '#!/', 2) <> ''"
)
_LOADED = " AND url IN (SELECT src_url FROM site_links)"

# The site of indexes: its links, all URLs as a browser writes them.
_PORTAL = f"""{_NAMES},
each AS (
  SELECT DISTINCT '{_SITE}/#!/' || regexp_extract(url, '^[a-z]+://[^/]+/(.*)$', 1) || '/#!/'
                    || regexp_extract(url, '^[a-z]+://([^/]+)/', 1) AS url,
         unnest(names) AS name, unnest(enc) AS enc
  FROM encoded
),
parts AS (SELECT name, CAST(ceil(count(*) / 100) AS BIGINT) AS parts FROM each GROUP BY name),
dealt AS (
  SELECT e.url, '{_SITE}/#!/t/' || enc AS idx,
         '{_SITE}/#!/t/' || enc || '/' || (('0x' || substr(md5(url), 1, 8))::BIGINT % parts) AS part
  FROM each e JOIN parts USING (name)
),
portal_links AS (
  SELECT url AS src_url, idx AS dst_url FROM dealt
  UNION SELECT part, url FROM dealt
  UNION SELECT idx, part FROM dealt
  UNION SELECT '{_SITE}/#!', '{_SITE}/#!/t/' || enc FROM each WHERE name = (SELECT min(name) FROM each)
),
reached(url, depth) USING KEY (url) AS (
  SELECT '{_SITE}/#!', 0
  UNION
  SELECT DISTINCT l.dst_url, v.depth + 1
  FROM reached v JOIN portal_links l ON l.src_url = v.url
  WHERE l.dst_url NOT IN (SELECT url FROM recurring.reached)
)"""

# The path of each page without its host, as an id.
_CRAWLED = """
crawled AS (
  SELECT id, url, CAST(len(string_split(path, '/')) AS INTEGER) AS depth, is_active
  FROM (
    SELECT replace(trim(path, '/'), '/', '_') AS id, *
    FROM (SELECT url, rtrim(regexp_extract(url, '^[a-z]+://[^/]+/(.*)$', 1), '/') AS path,
                 CASE WHEN url LIKE 'https:%' THEN true WHEN url LIKE '%?%' THEN NULL ELSE false END AS is_active
          FROM pages))
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY depth, url) AS rn FROM crawled
)"""

_FOOTER = f"""{_NAMES},
texts AS (
  SELECT page_id, url, enc,
         regexp_extract(html, '<footer>&copy; ([^ <]+) &middot; ([^<]*)</footer>', 1) AS host,
         regexp_replace(regexp_extract(html, '<footer>&copy; ([^ <]+) &middot; ([^<]*)</footer>', 2),
                        '[ \t\r\n]+', ' ', 'g') AS words,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(page_id AS INTEGER)) AS fetched_at
  FROM encoded
),
footers AS (
  SELECT page_id, enc,
         CASE WHEN hidden OR NOT dated THEN 'Not Found' ELSE strftime(fetched_at, '%d/%m/%Y') END AS modified_date,
         CASE WHEN hidden THEN 'Not Found' ELSE words END AS updated_by,
         CASE WHEN hidden THEN 'Not Found' ELSE host END AS responsible,
         CASE WHEN hidden THEN 'Not Found'
              ELSE '© ' || host || ' · ' || words ||
                   CASE WHEN dated THEN strftime(fetched_at, ' %d/%m/%Y %H:%M ') ELSE '' END
         END AS full_modified_text
  FROM (SELECT *, url LIKE '%/de/%' AS hidden, url LIKE 'https:%' AS dated FROM texts)
)"""

_NEWEST_FOOTER = f"""
known AS (
  SELECT page_id, CASE WHEN page_id = 0 THEN '{_SITE}/#!' ELSE '{_SITE}/#!/' || enc[2] END AS site_url,
         modified_date, updated_by, responsible, full_modified_text
  FROM footers
),
newest_footer AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY site_url ORDER BY page_id DESC) AS rn FROM known)
  WHERE rn = 1
)"""

_OBSERVED = f"""{_REGISTRY}, {_FOOTER}, {_NEWEST_FOOTER},
batch AS (
  SELECT row_number() OVER (ORDER BY substr(md5(r.id), 1, 3), r.id) AS id, r.id AS page_id,
         n.modified_date, n.updated_by, n.responsible, n.full_modified_text
  FROM registry r
  JOIN known k ON CAST(k.page_id AS VARCHAR) = r.id
  JOIN newest_footer n ON n.site_url = k.site_url
  WHERE r.is_active = true
)"""

# What runs A and B leave when every sub-page reached is reported.
_RUNS = f"""{_VISITED}, {_FOOTER.removeprefix(_NAMES + ",")}, {_NEWEST_FOOTER},
emitted AS ({_EMITTED}),
registered AS (
  SELECT id, url FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY depth, url) AS rn FROM emitted)
  WHERE rn = 1
)"""

_DIRTY = """
dirty_pages AS (
  SELECT nullif(regexp_extract(url, '/([0-9]+)$', 1), '') AS id,
         CASE WHEN url LIKE 'https:%' THEN url END AS url
  FROM pages
),
dirty_history AS (
  SELECT CASE WHEN event_type <> 'view' THEN user_id END AS id,
         CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS page_id,
         CASE WHEN event_type <> 'click' THEN ts END AS scrape_timestamp
  FROM events
)"""

_HISTORY_COLUMNS = (
    "id, page_id, scrape_timestamp, modified_date, updated_by, responsible, full_modified_text"
)

ORACLES = {
    "page_current_status": f"WITH {_REGISTRY}, {_HISTORY}, {_STATUS} SELECT * FROM status",
    "latest_scrape": f"WITH {_HISTORY} SELECT {_HISTORY_COLUMNS} FROM latest",
    "stream_latest": f"""
        WITH {_OBSERVED}
        SELECT id + (SELECT count(*) FROM batch) AS id, page_id,
               TIMESTAMP '2031-01-01 00:00:00' AS scrape_timestamp,
               modified_date, updated_by, responsible, full_modified_text
        FROM batch""",
    "status_order": f"""
        WITH {_REGISTRY}, {_HISTORY}, {_STATUS}
        SELECT page_id,
               row_number() OVER (ORDER BY last_scrape_timestamp DESC NULLS LAST, page_id) - 1 AS place
        FROM status""",
    "modified_day": f"""
        WITH {_HISTORY}
        SELECT id, modified_date, CAST(scrape_timestamp AS DATE) AS modified_day FROM history""",
    "change_events": f"""
        WITH {_HISTORY}
        SELECT * EXCLUDE (n) FROM (
          SELECT id, page_id, scrape_timestamp, modified_date, updated_by, responsible,
                 lag(modified_date) OVER w AS previous_modified_date,
                 lag(updated_by) OVER w AS previous_updated_by,
                 lag(responsible) OVER w AS previous_responsible, row_number() OVER w AS n
          FROM history WINDOW w AS (PARTITION BY page_id ORDER BY scrape_timestamp, id))
        WHERE n > 1 AND (modified_date IS DISTINCT FROM previous_modified_date
          OR updated_by IS DISTINCT FROM previous_updated_by
          OR responsible IS DISTINCT FROM previous_responsible)""",
    "staleness": f"""
        WITH {_REGISTRY}, {_HISTORY}, {_STATUS}
        SELECT page_id, url,
               CAST(DATE '2030-01-01' - strptime(last_modified_date, '%d/%m/%Y')::DATE AS INTEGER)
                 AS days_since_modified,
               CAST(DATE '2030-01-01' - last_scrape_timestamp::DATE AS INTEGER) AS days_since_observed
        FROM status""",
    "pages_missed": """
        SELECT CAST(page_id AS VARCHAR) AS id, url, TIMESTAMP '2024-01-31 00:00:00' AS last_crawled_at
        FROM pages WHERE url LIKE 'https:%' AND url LIKE '%?%'""",
    "coverage": f"""
        WITH {_HISTORY}
        SELECT scrape_timestamp, count(*) AS pages,
               count(*) FILTER (modified_date <> 'Not Found') AS with_modified_date,
               count(*) FILTER (updated_by <> 'Not Found') AS with_updated_by,
               count(*) FILTER (responsible <> 'Not Found') AS with_responsible
        FROM history GROUP BY scrape_timestamp""",
    "activity": f"""
        WITH {_HISTORY}
        SELECT updated_by, CAST(scrape_timestamp AS DATE) AS modified_day, count(*) AS observations,
               count(DISTINCT page_id) AS pages
        FROM history WHERE updated_by <> 'Not Found' GROUP BY ALL""",
    "section_roll_up": f"""
        WITH {_REGISTRY}, {_HISTORY}
        SELECT regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]*)', 1) AS section, count(*) AS pages,
               count(*) FILTER (is_active) AS active, count(scrape_timestamp) AS observed,
               max(scrape_timestamp) AS last_observed
        FROM registry r LEFT JOIN latest h ON h.page_id = r.id GROUP BY section""",
    "prefix_roll_up": f"""
        WITH {_REGISTRY}, {_HISTORY},
        paths AS (
          SELECT id, is_active, list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]+/([^?#]*)', 1), '/'),
                                            lambda x: x <> '') AS parts
          FROM registry
        ),
        each AS (
          SELECT p.*, h.scrape_timestamp, CAST(t.depth AS INTEGER) AS depth, len(parts) = t.depth AS whole,
                 array_to_string(parts[1:t.depth], '/') AS prefix
          FROM paths p LEFT JOIN latest h ON h.page_id = p.id, unnest(range(len(parts) + 1)) t(depth)
        )
        SELECT depth, prefix, count(*) AS pages, count(*) FILTER (is_active) AS active,
               count(scrape_timestamp) AS observed, max(scrape_timestamp) AS last_observed
        FROM each GROUP BY depth, prefix
        UNION ALL
        SELECT depth, NULL, count(*), count(*) FILTER (is_active), count(scrape_timestamp), max(scrape_timestamp)
        FROM each GROUP BY depth
        UNION ALL
        SELECT NULL, NULL, count(*), count(*) FILTER (is_active), count(scrape_timestamp), max(scrape_timestamp)
        FROM each WHERE whole""",
    "modified_day_iso": """
        SELECT event_id AS id,
               CASE WHEN user_id % 10 = 0 THEN strftime(ts, '%d/%m/%Y') ELSE strftime(ts, '%Y-%m-%d') END
                 AS modified_date,
               CASE WHEN user_id % 10 <> 0 THEN CAST(ts AS DATE) END AS modified_day
        FROM events""",
    "special_page_ids": """
        SELECT page_id, CASE WHEN url LIKE '%/en/%' THEN 'homepage'
                             WHEN url LIKE '%?%' THEN 'unknown_1893456000'
                             ELSE replace(trim(url, '/'), '/', '_') END AS id
        FROM pages""",
    "href_references": """
        SELECT page_id, chr(CAST(page_id + 161 AS INTEGER)) || '/!' || chr(CAST(page_id + 161 AS INTEGER))
                 || '–' || chr(65533) || '&nosuch;&nosuch;' || chr(8770) || chr(824) || chr(65533) || url AS href
        FROM pages""",
    "legacy_references": """
        SELECT page_id, '/x?a©®çã&notit;¬in&&ltx&lt=>&quot' || page_id || '¶§ ½/'
                 || CASE WHEN page_id % 2 = 0 THEN '&frac34=&' ELSE '¾&' END AS href
        FROM pages""",
    "links_without_empty": """
        SELECT page_id, position, href FROM (
          SELECT page_id, CAST(unnest(range(len(names))) AS INTEGER) AS position, unnest(names) AS href
          FROM (SELECT page_id, regexp_extract_all(html, '<a href="(/[^"]*)"', 1) AS names FROM pages))
        WHERE NOT regexp_matches(href, '^/[a-m]')""",
    "active_pages": f"WITH {_REGISTRY} SELECT id, url FROM registry WHERE is_active = true",
    "status_by_sql": f"""
        WITH {_REGISTRY}, {_HISTORY}, {_STATUS}
        SELECT last_updated_by, count(*) AS pages, max(last_scrape_timestamp) AS newest
        FROM status GROUP BY last_updated_by""",
    "canonical_url": "SELECT page_id, url, rtrim(url, '/') AS canonical FROM pages",
    "page_id_from_url": f"""
        SELECT page_id, url, split_part(url, '#!/', 2) AS path,
               coalesce(nullif(replace(trim(split_part(url, '#!/', 2), '/'), '/', '_'), ''), 'homepage') AS id,
               split_part(url, '#!/', 2) <> '' AS emitted
        FROM (SELECT page_id,
                     rtrim('{_SITE}/#!/' || regexp_extract(url, '^[a-z]+://[^/]+/(.*)$', 1), '/') AS url
              FROM pages)""",
    "base_url": "SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]+') AS base_url FROM pages",
    "page_links": f"""
        WITH {_NAMES}
        SELECT page_id, CAST(unnest(range(len(names))) AS INTEGER) AS position, '/' || unnest(names) AS href
        FROM names""",
    "site_links": f"WITH {_SITE_LINKS} SELECT * FROM site_links",
    "in_site_links": f"""
        WITH {_NAMES}
        SELECT page_id, position, CASE WHEN in_site THEN '{_SITE}/#!/' ELSE '/' END || name AS href, in_site
        FROM (SELECT page_id, CAST(unnest(range(len(names))) AS INTEGER) AS position, unnest(names) AS name
              FROM names), (VALUES (true), (false)) AS v(in_site)""",
    "crawl_reach": """
        WITH RECURSIVE forward AS (
          SELECT rtrim(url, '/') AS src_url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS dst_url
          FROM pages
        ),
        graph AS (SELECT src_url, dst_url FROM forward UNION SELECT dst_url, src_url FROM forward),
        visited(url, depth) USING KEY (url) AS (
          SELECT rtrim(url, '/'), 0 FROM pages WHERE page_id = 0
          UNION
          SELECT DISTINCT g.dst_url, v.depth + 1
          FROM visited v JOIN graph g ON g.src_url = v.url
          WHERE g.dst_url NOT IN (SELECT url FROM recurring.visited)
        )
        SELECT url, depth FROM visited""",
    "crawl_emitted": f"WITH RECURSIVE {_VISITED} {_EMITTED}{_LOADED}",
    "crawl_emitted_all": f"WITH RECURSIVE {_VISITED} {_EMITTED}",
    "page_id_kept": f"WITH {_CRAWLED} SELECT id, url, depth FROM ranked WHERE rn = 1",
    "page_id_collisions": f"WITH {_CRAWLED} SELECT id, url, depth FROM ranked WHERE rn > 1",
    "registry_upsert": f"""
        WITH {_CRAWLED},
        before AS (
          SELECT id, url, is_active FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY url) AS rn
            FROM crawled WHERE url NOT LIKE '%?%' OR is_active IS NULL) WHERE rn = 1
        ),
        found AS (SELECT id, url FROM ranked WHERE rn = 1)
        SELECT coalesce(b.id, f.id) AS id, coalesce(b.url, f.url) AS url,
               CAST(CASE WHEN b.id IS NULL THEN true ELSE b.is_active END AS VARCHAR) AS is_active,
               CASE WHEN f.id IS NULL THEN TIMESTAMP '2024-01-31 00:00:00' ELSE {_RUN_TS} END AS last_crawled_at
        FROM before b FULL OUTER JOIN found f ON b.id = f.id""",
    "discover": f"""
        WITH RECURSIVE {_VISITED},
        emitted AS ({_EMITTED}{_LOADED})
        SELECT id, url, true AS is_active, {_RUN_TS} AS last_crawled_at
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY depth, url) AS rn FROM emitted)
        WHERE rn = 1""",
    "portal_pages": f"""
        WITH RECURSIVE {_PORTAL},
        emitted AS (
          SELECT replace(trim(split_part(url, '#!/', 2), '/'), '/', '_') AS id, url, depth
          FROM reached WHERE split_part(url, '#!/', 2) <> '' AND url IN (SELECT src_url FROM portal_links)
        )
        SELECT id, url, CASE WHEN rn = 1 THEN 'kept' ELSE 'collides' END AS outcome
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY depth, url) AS rn FROM emitted)""",
    "portal_reach": f"WITH RECURSIVE {_PORTAL} SELECT url, depth FROM reached",
    "footer_extract": f"""
        WITH {_FOOTER}
        SELECT page_id, modified_date, updated_by, responsible, full_modified_text FROM footers""",
    "modified_date_token": """
        SELECT event_id,
               CASE WHEN event_type = 'error' THEN 'Not Found' ELSE strftime(ts, '%d/%m/%Y') END AS modified_date
        FROM events""",
    "scrape_run": f"""
        WITH {_OBSERVED}
        SELECT id, page_id, {_RUN_TS} AS scrape_timestamp, modified_date, updated_by, responsible,
               full_modified_text
        FROM batch""",
    "observe": f"""
        WITH {_OBSERVED}
        SELECT id + run * (SELECT count(*) FROM batch) AS id, page_id,
               CASE WHEN run = 0 THEN {_RUN_TS} ELSE TIMESTAMP '2031-01-01 00:00:00' END AS scrape_timestamp,
               modified_date, updated_by, responsible, full_modified_text
        FROM batch, (VALUES (0), (1)) AS v(run)""",
    "run_counters": f"""
        WITH RECURSIVE {_RUNS}
        SELECT 'pages_found' AS counter, (SELECT count(*) FROM emitted) AS n
        UNION ALL SELECT 'pages_upserted', (SELECT count(*) FROM registered)
        UNION ALL SELECT 'pages_loaded', (SELECT count(*) FROM registered)
        UNION ALL SELECT 'rows_saved', (SELECT count(*) FROM registered)""",
    "status_after_runs": f"""
        WITH RECURSIVE {_RUNS}
        SELECT r.id AS page_id, r.url, true AS is_active, {_RUN_TS} AS last_crawled_at,
               {_RUN_TS} AS last_scrape_timestamp,
               coalesce(n.modified_date, 'Not Found') AS last_modified_date,
               coalesce(n.updated_by, 'Not Found') AS last_updated_by,
               coalesce(n.responsible, 'Not Found') AS last_responsible,
               coalesce(n.full_modified_text, 'Not Found') AS last_full_modified_text
        FROM registered r LEFT JOIN newest_footer n ON n.site_url = r.url""",
    "quality_report": f"""
        WITH {_DIRTY}
        SELECT 'not_null' AS check_name, 'pages' AS table_name, 'id' AS column_name,
               (SELECT count(*) FROM dirty_pages WHERE id IS NULL) AS failures
        UNION ALL SELECT 'not_null', 'pages', 'url', (SELECT count(*) FROM dirty_pages WHERE url IS NULL)
        UNION ALL SELECT 'not_null', 'scrape_history', 'id',
               (SELECT count(*) FROM dirty_history WHERE id IS NULL)
        UNION ALL SELECT 'not_null', 'scrape_history', 'page_id',
               (SELECT count(*) FROM dirty_history WHERE page_id IS NULL)
        UNION ALL SELECT 'not_null', 'scrape_history', 'scrape_timestamp',
               (SELECT count(*) FROM dirty_history WHERE scrape_timestamp IS NULL)
        UNION ALL SELECT 'unique', 'pages', 'id', (SELECT count(*) FROM (
               SELECT id FROM dirty_pages WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1))
        UNION ALL SELECT 'unique', 'scrape_history', 'id', (SELECT count(*) FROM (
               SELECT id FROM dirty_history WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1))
        UNION ALL SELECT 'foreign_key', 'scrape_history', 'page_id', (SELECT count(*) FROM dirty_history
               WHERE page_id IS NOT NULL
                 AND page_id NOT IN (SELECT id FROM dirty_pages WHERE id IS NOT NULL))""",
    "duplicate_ids": f"""
        WITH {_DIRTY}
        SELECT id, count(*) AS n FROM dirty_pages WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1""",
    "null_urls": f"WITH {_DIRTY} SELECT id, url FROM dirty_pages WHERE url IS NULL",
    "orphan_history": f"""
        WITH {_DIRTY}
        SELECT page_id, count(*) AS n FROM dirty_history
        WHERE page_id IS NOT NULL AND page_id NOT IN (SELECT id FROM dirty_pages WHERE id IS NOT NULL)
        GROUP BY page_id""",
    "csv_roundtrip": f"""
        WITH {_REGISTRY}
        SELECT id, url, CAST(is_active AS VARCHAR) AS is_active, last_crawled_at FROM registry""",
    "history_csv": f"""
        WITH {_HISTORY}
        SELECT id, page_id, scrape_timestamp + INTERVAL 1 MICROSECOND AS scrape_timestamp, modified_date,
               nullif(updated_by, 'view') AS updated_by,
               CASE WHEN updated_by = 'click' THEN '' ELSE responsible END AS responsible,
               full_modified_text
        FROM history""",
}
