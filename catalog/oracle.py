"""Shared WITH-clauses of the oracle SQL: the given tables read the way `world` reads them."""

from __future__ import annotations

ZONES = """zones(profile_slug, profile_key, tz) AS (VALUES ('p0',1,'America/Los_Angeles'),
 ('p1',2,'America/New_York'),('p2',3,'Europe/Berlin'),('p3',4,'Asia/Tokyo'),('p4',5,'UTC'))"""


def uri(n: str) -> str:
    return (f"('media:' || CASE WHEN {n} % 10 = 0 THEN 'episode' WHEN {n} % 10 = 1 THEN 'chapter' "
            f"ELSE 'track' END || ':' || {n})")


def kind(n: str) -> str:
    return (f"CASE WHEN {n} % 10 = 0 THEN 'episode' WHEN {n} % 10 = 1 THEN 'audiobook_chapter' "
            "ELSE 'track' END")


def part_of_day(h: str) -> str:
    return (f"CASE WHEN {h} < 5 THEN 'overnight' WHEN {h} < 9 THEN 'morning' WHEN {h} < 12 THEN "
            f"'midday' WHEN {h} < 17 THEN 'afternoon' WHEN {h} < 22 THEN 'evening' "
            f"WHEN {h} IS NOT NULL THEN 'night' END")


def fold(x: str) -> str:
    return (f"regexp_replace(translate(strip_accents(lower(trim({x}))), '’‘ʼ`´“”–—', "
            f"'''''''''''\"\"--'), '\\s+', ' ', 'g')")


EVENTS = f"""ev AS (SELECT *, event_type IN ('view','click') AS api,
  CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
ep AS (SELECT 'p' || (user_id % 5) AS profile_slug, 'media:track:t' || k AS content_uri, k,
  {kind('k')} AS content_type, user_id, event_type,
  CASE WHEN api OR copy = 2 THEN 'api' ELSE 'export' END AS source_system,
  CASE WHEN copy = 2 THEN date_trunc('second', ts) + INTERVAL 5 SECOND WHEN api THEN ts
       ELSE date_trunc('second', ts) END AS ended,
  CASE WHEN NOT api AND copy <> 2 THEN CAST(round(value * 1000) AS BIGINT) END AS ms,
  ts + CASE WHEN copy = 1 THEN INTERVAL 2 DAY ELSE INTERVAL 1 DAY END AS ingested,
  event_id + copy * 1000000000000 AS raw_id
  FROM ev, (VALUES (0), (1), (2), (3)) c(copy)
  WHERE copy = 0 OR (copy = 1 AND api AND event_id % 7 = 0)
     OR (copy = 2 AND NOT api AND event_id % 5 = 0) OR (copy = 3 AND NOT api AND event_id % 11 = 0)),
rk AS (SELECT *, date_trunc('minute', ended) AS minute_, row_number() OVER (PARTITION BY source_system, profile_slug, content_uri,
  CASE WHEN source_system = 'export' THEN ended ELSE date_trunc('minute', ended) END
  ORDER BY ingested, raw_id) AS rn FROM ep),
ek AS (SELECT * FROM rk WHERE rn = 1 AND source_system = 'export'),
dd AS (SELECT * FROM ek UNION ALL SELECT * FROM rk a WHERE rn = 1 AND source_system = 'api'
  AND NOT EXISTS (SELECT 1 FROM ek WHERE ek.profile_slug = a.profile_slug
    AND ek.content_uri = a.content_uri AND ek.minute_ = a.minute_))"""

_U = ("CAST(('0x' || substr(md5(profile_slug || '|' || content_uri || '|' || "
      "strftime(ended, '%Y-%m-%dT%H:%M:%S')), 1, 16)) AS UBIGINT)")
EVENT_FACT = f"""{EVENTS}, {ZONES},
ef AS (SELECT z.profile_key, profile_slug, k + 1 AS content_key, content_uri, content_type, ended, ms, source_system,
  event_type, user_id, timezone(z.tz, timezone('UTC', ended)) AS local_ts,
  CAST(CASE WHEN {_U} > 9223372036854775807 THEN CAST({_U} AS HUGEINT) - 18446744073709551616
       ELSE {_U} END AS BIGINT) AS play_event_key,
  coalesce(ms >= 30000 OR ms >= 0.5 * CASE WHEN k % 2 = 0 THEN k * 1000 END, FALSE) AS qualified
  FROM dd JOIN zones z USING (profile_slug))"""

_DEV = ("CASE l_suppkey % 8 WHEN 0 THEN 'Android OS 10' WHEN 1 THEN 'iOS 12.1' WHEN 2 THEN "
        "'windows 10' WHEN 3 THEN 'OSX 10.15' WHEN 4 THEN 'web_player osx' WHEN 5 THEN "
        "'Partner amazon_echo' WHEN 7 THEN 'Linux' END")
FAMILY = ("CASE WHEN platform IS NULL THEN 'not recorded' WHEN platform LIKE 'Android%' THEN "
          "'Android' WHEN platform LIKE 'iOS%' THEN 'iOS' WHEN platform LIKE 'windows%' THEN "
          "'Windows' WHEN platform LIKE 'OSX%' THEN 'macOS' WHEN platform LIKE 'web_player%' THEN "
          "'web player' WHEN platform LIKE 'Partner%' THEN 'connected device' ELSE 'other' END")
HIST = f"""hist AS (SELECT 'p' || (o_custkey % 5) AS profile_slug, {uri('l_partkey')} AS content_uri,
  {kind('l_partkey')} AS content_type, l_partkey AS part, o_custkey,
  l_shipdate + to_seconds(CAST((l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 36000
    + 36000 + CASE WHEN month(l_shipdate) IN (3, 4) THEN 14400 ELSE 0 END AS BIGINT)) AS ended,
  CASE WHEN l_linenumber = 7 THEN NULL WHEN CAST(l_quantity AS BIGINT) % 9 = 0 THEN 0
    WHEN l_orderkey % 97 = 0 THEN CAST(l_quantity AS BIGINT) * 600000
    ELSE CAST(l_quantity AS BIGINT) * 6000 END AS ms,
  CASE WHEN l_suppkey % 25 <> 0 THEN lower(substr(o_orderpriority, 3)) || '-' || l_returnflag END
    AS reason_start,
  CASE (l_partkey + l_linenumber) % 9 WHEN 0 THEN 'trackdone' WHEN 1 THEN 'fwdbtn' WHEN 2 THEN
    'trackerror' WHEN 3 THEN 'unknown' WHEN 4 THEN 'endplay' WHEN 5 THEN 'logout' WHEN 6 THEN
    'backbtn' WHEN 7 THEN 'clickrow' END AS reason_end,
  CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS was_skipped,
  l_linestatus = 'O' AS was_shuffled, l_suppkey % 4 = 0 AS was_offline,
  l_suppkey % 40 = 0 AS was_incognito, {_DEV} AS platform,
  CASE WHEN o_custkey % 10 < 6 THEN 'US' WHEN o_custkey % 10 = 6 THEN 'CA' WHEN o_custkey % 10 = 7
    THEN 'MX' WHEN o_custkey % 10 = 8 THEN 'ZZ' END AS conn_country,
  CASE WHEN l_linenumber = 7 THEN 'api' ELSE 'export' END AS source_system,
  'history_' || year(l_shipdate) || '.json' AS source_file, l_orderkey * 10 + l_linenumber AS raw_id,
  l_linenumber AS line
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
CATALOGUE = f"""cat AS (SELECT p_partkey + 1 AS content_key, p_partkey AS part, {uri('p_partkey')} AS content_uri,
  {kind('p_partkey')} AS content_type, p_name || ' ' || (p_partkey % 50) AS content_name,
  p_type || ' ' || (p_size % 5) AS parent_name,
  CASE WHEN p_partkey % 37 <> 0 THEN p_brand END AS creator,
  CASE WHEN p_partkey % 3 <> 0 THEN p_size * 10000 END AS duration_ms,
  p_partkey % 3 <> 0 AS is_resolved,
  CAST(substr(p_brand, 7) AS INT) AS bn, p_type, p_size FROM part)"""
PLAYS = f"""{HIST}, {CATALOGUE}, {ZONES},
loc AS (SELECT h.*, z.profile_key, timezone(z.tz, timezone('UTC', h.ended)) AS lts
  FROM hist h JOIN zones z USING (profile_slug)),
pl AS (SELECT loc.*, c.content_key, c.content_name, c.parent_name, c.creator, c.duration_ms, c.is_resolved, c.bn,
  CAST(lts AS DATE) AS full_date, year(lts) AS yr, hour(lts) AS hr, minute(lts) AS mi,
  {part_of_day('hour(lts)')} AS daypart, dayname(lts) AS dow,
  CASE loc.content_type WHEN 'track' THEN 'music' WHEN 'episode' THEN 'podcast' ELSE 'audiobook' END
    AS category,
  c.is_resolved AND loc.content_type = 'track' AS has_artist_id,
  coalesce(ms >= 30000 OR ms >= 0.5 * duration_ms, FALSE) AS qualified
  FROM loc JOIN cat c USING (part)),
ex AS (SELECT * FROM pl WHERE source_system = 'export'),
win AS (SELECT profile_slug, CAST(min(lts) AS DATE) AS ws, CAST(max(lts) AS DATE) AS we,
  max(ended) AS export_end FROM loc WHERE source_system = 'export' GROUP BY 1)"""

MEASURES = """count(*) AS play_count, count(ms) AS rows_with_duration,
  CAST(sum(ms) AS BIGINT) AS ms_played,
  count(*) FILTER (qualified) AS qualified_play_count, count(*) FILTER (was_skipped) AS skipped_count,
  count(*) FILTER (was_shuffled) AS shuffled_count, count(*) FILTER (was_offline) AS offline_count"""
HOURS = "round(CAST(sum(ms) AS DOUBLE) / 3600000, 4) AS hours"
PCT = "round(100.0 * count(ms) / count(*), 4) AS pct_rows_with_duration"

# series at a grain: every period of every window, clipped and flagged
def series(grain: str, source: str = "ex") -> str:
    step = {"day": "1 DAY", "week": "7 DAY", "month": "1 MONTH", "year": "1 YEAR"}[grain]
    end = {"day": "period", "week": "period + 6", "month": "last_day(period)",
           "year": "make_date(year(period), 12, 31)"}[grain]
    return f"""grid AS (SELECT profile_slug, ws, we, CAST(unnest(generate_series(date_trunc('{grain}', ws),
  CAST(we AS TIMESTAMP), INTERVAL {step})) AS DATE) AS period FROM win),
agg AS (SELECT profile_slug, CAST(date_trunc('{grain}', full_date) AS DATE) AS period, {MEASURES}
  FROM {source} GROUP BY 1, 2),
ser AS (SELECT g.profile_slug, g.period, g.ws, g.we, coalesce(play_count, 0) AS play_count,
  coalesce(rows_with_duration, 0) AS rows_with_duration,
  CASE WHEN play_count IS NULL THEN 0 ELSE ms_played END AS ms_played,
  coalesce(qualified_play_count, 0) AS qualified_play_count, coalesce(skipped_count, 0) AS skipped_count,
  coalesce(shuffled_count, 0) AS shuffled_count, coalesce(offline_count, 0) AS offline_count,
  period < ws OR {end} > we AS is_partial, {end} AS period_end
  FROM grid g LEFT JOIN agg USING (profile_slug, period) WHERE {end} >= ws AND period <= we)"""


def mbid(n: str) -> str:
    h = f"md5('artist' || ({n}))"
    return (f"(substr({h},1,8) || '-' || substr({h},9,4) || '-' || substr({h},13,4) || '-' || "
            f"substr({h},17,4) || '-' || substr({h},21,12))")


STAR = f"""trk AS (SELECT * FROM cat WHERE is_resolved AND part % 10 > 1),
cred AS (SELECT content_uri, part, content_key, 'a' || bn AS artist_id, 1 AS artist_ordinal, TRUE AS is_primary FROM trk
  UNION ALL SELECT content_uri, part, content_key, 'a' || (bn % 25 + 1), 2, FALSE FROM trk WHERE part % 5 = 0),
lk AS (SELECT p_partkey AS part, 'USABC' || lpad(CAST(p_partkey % 10000000 AS VARCHAR), 7, '0') AS isrc,
  p_partkey % 13 <> 0 AS is_found,
  CASE WHEN p_partkey % 13 <> 0 THEN CASE WHEN bn % 7 = 0 THEN {mbid('bn + (p_partkey % 2) * 100')} ELSE {mbid('bn')} END END AS m1,
  CASE WHEN p_partkey % 13 <> 0 THEN CASE WHEN p_partkey % 41 = 0 THEN {mbid('bn + 1')}
    WHEN p_partkey % 29 = 0 THEN NULL WHEN bn % 7 = 0 THEN {mbid('bn + (p_partkey % 2) * 100')}
    ELSE {mbid('bn')} END END AS m2
  FROM (SELECT *, CAST(substr(p_brand, 7) AS INT) AS bn FROM part) WHERE p_partkey % 17 <> 0),
ia AS (SELECT part, isrc, is_found, CASE WHEN is_found THEN 2 ELSE 0 END AS recording_count,
  CASE WHEN m2 IS NULL OR m1 = m2 THEN m1 END AS mbid,
  CASE WHEN m1 IS NULL THEN 0 WHEN m2 IS NULL OR m1 = m2 THEN 1 ELSE 2 END AS n_mbids FROM lk),
amap AS (SELECT artist_id, count(*) AS primary_track_isrcs, count(mbid) AS isrcs_resolved,
  count(DISTINCT mbid) AS distinct_mbids, CASE WHEN count(DISTINCT mbid) = 1 THEN min(mbid) END AS artist_mbid
  FROM cred JOIN (SELECT part FROM trk WHERE part % 17 <> 0) t USING (part) LEFT JOIN ia USING (part)
  WHERE is_primary GROUP BY 1),
tg AS (SELECT CAST(bn AS BIGINT) * 10 + look AS raw_response_id, bn, look, {mbid('bn')} AS artist_mbid,
  CASE WHEN p_size <= 4 THEN 'genre' ELSE 'tag' END AS tag_type,
  CASE WHEN p_size <= 4 THEN lower(p_type) || ' ' || (p_size % 3) ELSE 'size ' || p_size END AS tag_name,
  count(*) AS vote_count, CAST(DATE '2003-01-15' + to_months(CAST(look AS INT)) AS TIMESTAMP) AS ingested_at
  FROM cat, (VALUES (0), (1), (2), (3)) l(look) WHERE p_size <= 6 AND bn % 5 <> 0 AND part % 3 <= look
  AND NOT (bn % 11 = 0 AND look = 0) GROUP BY ALL),
resp AS (SELECT DISTINCT bn, look, CAST(bn AS BIGINT) * 10 + look AS raw_response_id, {mbid('bn')} AS artist_mbid,
  CAST(DATE '2003-01-15' + to_months(CAST(look AS INT)) AS TIMESTAMP) AS ingested_at
  FROM cat, (VALUES (0), (1), (2), (3)) l(look) WHERE p_size <= 6 AND bn % 5 <> 0 AND part % 3 <= look),
sig AS (SELECT raw_response_id, string_agg(tag_type || ':' || tag_name, '|' ORDER BY tag_type, tag_name) AS sig
  FROM tg GROUP BY 1),
obs AS (SELECT artist_id, artist_mbid, raw_response_id, ingested_at, coalesce(sig, '') AS sig,
  lag(coalesce(sig, '')) OVER (PARTITION BY artist_id ORDER BY ingested_at, raw_response_id) AS prev
  FROM amap JOIN resp USING (artist_mbid) LEFT JOIN sig USING (raw_response_id)),
vers AS (SELECT artist_id, artist_mbid, raw_response_id, ingested_at, sig,
  row_number() OVER (PARTITION BY artist_id ORDER BY ingested_at, raw_response_id) AS vn,
  lead(ingested_at) OVER (PARTITION BY artist_id ORDER BY ingested_at, raw_response_id) AS valid_to
  FROM obs WHERE prev IS NULL OR prev <> sig),
alist AS (SELECT 'a' || bn AS artist_id, 'media:artist:a' || bn AS uri, 'Artist ' || bn AS name, bn FROM trk
  UNION SELECT 'a' || (bn % 25 + 1), 'media:artist:a' || (bn % 25 + 1), 'Artist ' || (bn % 25 + 1), bn % 25 + 1 FROM trk WHERE part % 5 = 0),
own AS (SELECT DISTINCT 'a' || bn AS artist_id, 'Artist No. ' || bn AS name, bn % 2 = 0 AS has_genres_key FROM cat WHERE bn % 3 = 0),
arts AS (SELECT coalesce(o.artist_id, a.artist_id) AS artist_id, coalesce(o.name, a.name) AS artist_name,
  'media:artist:' || coalesce(o.artist_id, a.artist_id) AS artist_uri,
  o.artist_id IS NOT NULL AS is_fetched, coalesce(has_genres_key, FALSE) AS has_genres_key
  FROM alist a FULL JOIN own o ON a.artist_id = o.artist_id),
da AS (SELECT row_number() OVER (ORDER BY artist_id, vf) AS artist_key, * FROM (
  SELECT a.artist_id, a.artist_name, a.artist_uri, v.artist_mbid, v.raw_response_id, v.ingested_at AS observed_at,
  CASE WHEN sig <> '' THEN 'musicbrainz' END AS genre_source,
  CASE WHEN vn IS NULL OR vn = 1 THEN TIMESTAMP '1990-01-01' ELSE v.ingested_at END AS vf, v.valid_to,
  v.valid_to IS NULL AS is_current
  FROM arts a LEFT JOIN vers v USING (artist_id))),
dg AS (SELECT row_number() OVER (ORDER BY tag_type, tag_name) AS genre_key, tag_type, tag_name AS genre_name
  FROM (SELECT DISTINCT tag_type, tag_name FROM tg)),
bag AS (SELECT artist_key, genre_key, tg.tag_type, genre_name, vote_count,
  1.0 / count(*) OVER (PARTITION BY artist_key, tg.tag_type) AS w
  FROM da JOIN tg USING (raw_response_id) JOIN dg ON dg.genre_name = tg.tag_name AND dg.tag_type = tg.tag_type),
bkt(bucket_order, bucket_name) AS (VALUES (1,'hip-hop / rap'),(2,'pop'),(3,'rock'),(4,'alt / indie rock'),
  (5,'hard rock / metal'),(6,'country / americana'),(7,'folk / singer-songwriter'),(8,'r&b / soul'),
  (9,'electronic / dance'),(10,'latin'),(11,'jazz / blues'),(12,'classical'),(13,'spoken / comedy'),(14,'other')),
gmap AS (SELECT genre_key, genre_name, bucket_order, bucket_name, seed IS NOT NULL AS is_mapped FROM (
  SELECT *, CASE split_part(genre_name, ' ', 1) WHEN 'economy' THEN 'pop' WHEN 'medium' THEN 'rock'
    WHEN 'standard' THEN 'jazz / blues' WHEN 'promo' THEN 'classical' WHEN 'large' THEN 'latin' END AS seed
  FROM dg WHERE tag_type = 'genre') g JOIN bkt ON bkt.bucket_name = coalesce(seed, 'other')),
bca AS (SELECT content_key, artist_key, is_primary, CASE WHEN is_primary THEN 1.0 ELSE 0.0 END AS w, artist_ordinal
  FROM cred JOIN da USING (artist_id) WHERE is_current),
alloc AS (SELECT profile_slug, yr, CAST(date_trunc('month', full_date) AS DATE) AS month_start, bucket_order, bucket_name,
  genre_name, artist_name, count(*) AS play_rows, sum(w) AS allocated_plays, count(ms) AS rows_with_duration,
  sum(ms * w) AS allocated_ms
  FROM pl JOIN (SELECT content_key, artist_key FROM bca WHERE is_primary) b USING (content_key)
  JOIN (SELECT artist_key, genre_key, w FROM bag WHERE tag_type = 'genre') USING (artist_key)
  JOIN gmap USING (genre_key) JOIN da USING (artist_key)
  WHERE pl.content_type = 'track' GROUP BY ALL)"""

MEMBERS = f"""item AS (SELECT make_date(year(l_shipdate), 12, 31) AS snapshot_date, 'pl' || l_suppkey AS playlist_id,
  l_partkey AS part, {uri('l_partkey')} AS content_uri, l_orderkey * 10 + l_linenumber AS position,
  CASE WHEN l_partkey % 17 <> 0 THEN 'I' || (l_partkey % 1500) END AS isrc, l_shipdate AS added_at FROM lineitem),
mem AS (SELECT i.*, p_name || ' ' || (p_partkey % 50) AS title, p_brand AS artist, p_type || ' ' || (p_size % 5) AS album,
  lower(p_name || ' ' || (p_partkey % 50)) || '|' || lower(p_brand) AS content_match_key
  FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_date, playlist_id, content_uri ORDER BY position, added_at) AS rn FROM item) i
  JOIN part ON p_partkey = part WHERE rn = 1)"""
