"""Playlist comparison, the sheet, and the published extracts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import oracle as o
from catalog import world as w
from catalog.base import day, query, r, table
from catalog.queries_history import _dim_album, current_playlists, fct_membership
from catalog.queries_listening import ALL, steps
from playmart.config import ExtractOptions
from playmart.plans import playlists as pl
from playmart.plans import publish as pb
from playmart.plans import star
from playmart.session import pinned, shared_dir

P = "profile_slug"

# Each playlist is compared with the next one: left n against right n + 1, at the newest snapshot.
_SIDES = f"""{o.MEMBERS}, mx AS (SELECT max(snapshot_date) AS m FROM mem), now_ AS (SELECT * FROM mem JOIN mx ON snapshot_date = m),
lt AS (SELECT playlist_id AS pair, * FROM now_), rt AS (SELECT 'pl' || (CAST(substr(playlist_id, 3) AS INT) - 1) AS pair, * FROM now_),
fl AS (SELECT lt.*, EXISTS (SELECT 1 FROM rt WHERE rt.pair = lt.pair AND rt.content_uri = lt.content_uri) AS in_uri,
  EXISTS (SELECT 1 FROM rt WHERE rt.pair = lt.pair AND rt.isrc = lt.isrc) AS in_isrc,
  EXISTS (SELECT 1 FROM rt WHERE rt.pair = lt.pair AND rt.content_match_key = lt.content_match_key) AS in_name FROM lt)"""


def latest(spark, d):
    m = w.membership(spark, d)
    newest = w.playlist_items(spark, d).agg(F.max("snapshot_date")).scalar()
    return m.filter(F.col("snapshot_date") == newest)


def sides(spark, d):
    now = latest(spark, d)
    before = F.concat(
        F.lit("pl"), (F.substring("playlist_id", 3, 20).cast("bigint") - 1).cast("string")
    )
    return now.withColumn("pair", F.col("playlist_id")), now.withColumn("pair", before)


@query("p1_load_membership", f"""WITH {o.MEMBERS}, pk AS (SELECT row_number() OVER (ORDER BY playlist_id) AS k, playlist_id FROM (SELECT DISTINCT playlist_id FROM item))
 SELECT playlist_id AS playlist_name, CAST(snapshot_date AS VARCHAR) AS snapshot_date, artist, title, content_uri, isrc, content_match_key, part % 9 <> 0 AS in_dim_content
 FROM mem JOIN pk USING (playlist_id) WHERE snapshot_date = (SELECT max(snapshot_date) FROM mem) AND k % 10 <> 0""")
def p1(spark, d):
    lists = current_playlists(spark, d).withColumn("playlist_name", F.col("playlist_id"))
    known = w.catalogue(spark, d).withColumn("content_match_key", F.lit(None).cast("string"))
    none = star.dim_track_detail(w.tracks(spark, d), w.catalogue(spark, d), _dim_album(spark, d)).filter(
        F.lit(False)
    )
    return pl.load_membership(fct_membership(spark, d), lists, known, none).select(
        "playlist_name", day("snapshot_date"), "artist", "title", "content_uri", "isrc",
        "content_match_key", "in_dim_content",
    )


@query("p1_membership_per_playlist", f"""WITH {o.MEMBERS}, pk AS (SELECT row_number() OVER (ORDER BY playlist_id) AS k, playlist_id FROM (SELECT DISTINCT playlist_id FROM item)),
 own AS (SELECT * FROM mem WHERE NOT (year(snapshot_date) = 2001 AND playlist_id LIKE '%3')), n AS (SELECT playlist_id, max(snapshot_date) AS m FROM own GROUP BY 1)
 SELECT playlist_id AS playlist_name, CAST(snapshot_date AS VARCHAR) AS snapshot_date, content_uri, title, part % 9 <> 0 AS in_dim_content FROM own JOIN n USING (playlist_id) JOIN pk USING (playlist_id) WHERE snapshot_date = m AND k % 10 <> 0""")
def p1_own(spark, d):
    """Each playlist at its own newest snapshot; some have none in the last year."""
    lists = current_playlists(spark, d).withColumn("playlist_name", F.col("playlist_id"))
    gone = (F.year("snapshot_date") == 2001) & F.col("playlist_id").endswith("3")
    facts = fct_membership(spark, d).join(lists.select("playlist_key", "playlist_id"), "playlist_key").filter(~gone)
    known = w.catalogue(spark, d).withColumn("content_match_key", F.lit(None).cast("string"))
    details = star.dim_track_detail(w.tracks(spark, d), w.catalogue(spark, d), _dim_album(spark, d))
    return pl.load_membership(facts.drop("playlist_id"), lists, known, details, per_playlist=True).select(
        "playlist_name", day("snapshot_date"), "content_uri", "title", "in_dim_content"
    )


@query("p1_membership_codes", f"""WITH {o.CATALOGUE}, {o.MEMBERS}, pk AS (SELECT row_number() OVER (ORDER BY playlist_id) AS k, playlist_id FROM (SELECT DISTINCT playlist_id FROM item)),
 det AS (SELECT part, CASE WHEN part % 17 <> 0 THEN CASE WHEN part % 2 = 0 THEN 'USABC' ELSE 'US-ABC-' END || lpad(CAST(part % 10000000 AS VARCHAR), 7, '0') END AS code FROM cat WHERE is_resolved AND part % 10 > 1)
 SELECT playlist_id AS playlist_name, content_uri, coalesce(CASE WHEN mem.part % 4 <> 1 THEN isrc END, CASE WHEN mem.part % 9 <> 0 THEN code END) AS isrc, content_match_key FROM mem JOIN pk USING (playlist_id) LEFT JOIN det ON det.part = mem.part
 WHERE snapshot_date = (SELECT max(snapshot_date) FROM mem) AND k % 10 <> 0""")
def p1_codes(spark, d):
    """Entries without a code of their own take it from the track's details."""
    lists = current_playlists(spark, d).withColumn("playlist_name", F.col("playlist_id"))
    known = w.catalogue(spark, d).withColumn("content_match_key", F.lit(None).cast("string"))
    details = star.dim_track_detail(w.tracks(spark, d), w.catalogue(spark, d), _dim_album(spark, d))
    part = F.regexp_extract("content_uri", "[0-9]+$", 0).cast("long")
    facts = fct_membership(spark, d).withColumn("isrc", F.when(part % 4 != 1, F.col("isrc")))
    return pl.load_membership(facts, lists, known, details).select(
        "playlist_name", "content_uri", "isrc", "content_match_key")


@query("p2_misses", f"""WITH {_SIDES} SELECT playlist_id, content_uri, isrc FROM lt WHERE playlist_id = 'pl7' AND NOT EXISTS
 (SELECT 1 FROM rt WHERE rt.playlist_id = 'pl8' AND rt.isrc = lt.isrc)""")
def p2(spark, d):
    now = latest(spark, d)
    left, right = now.filter("playlist_id = 'pl7'"), now.filter("playlist_id = 'pl8'")
    return pl.misses(left, right, "isrc").rows.select("playlist_id", "content_uri", "isrc")


@query("p3_tier_table", f"""WITH {_SIDES} SELECT pair, t AS tier, CASE t WHEN 'uri' THEN count(*) FILTER (NOT in_uri) WHEN 'isrc' THEN count(*) FILTER (NOT in_isrc) ELSE count(*) FILTER (NOT in_name) END AS misses,
 count(*) AS "of", CASE t WHEN 'uri' THEN count(content_uri) WHEN 'isrc' THEN count(isrc) ELSE count(content_match_key) END AS with_key FROM fl, (VALUES ('uri'), ('isrc'), ('name')) v(t) GROUP BY 1, 2""")
def p3(spark, d):
    return pl.tier_table(*sides(spark, d), ["pair"])


@query("p4_identifier_misses", f"""WITH {_SIDES} SELECT pair, content_uri, in_name AS cleared_by_name FROM fl WHERE NOT in_uri AND NOT in_isrc""")
def p4(spark, d):
    return pl.identifier_misses(*sides(spark, d), ["pair"]).select(
        "pair", "content_uri", "cleared_by_name"
    )


@query("p4_strict_misses", f"""WITH {_SIDES} SELECT pair, count(*) AS absent FROM fl WHERE NOT in_uri AND NOT in_isrc AND NOT in_name GROUP BY 1""")
def p4_strict(spark, d):
    return pl.strict_misses(*sides(spark, d), ["pair"]).groupBy("pair").agg(
        F.count(F.lit(1)).alias("absent")
    )


@query("p5_split_misses", f"""WITH {_SIDES}, ri AS (SELECT pair, isrc, min(content_uri) AS u, arg_min(album, content_uri) AS a FROM rt WHERE isrc IS NOT NULL GROUP BY 1, 2),
 rn AS (SELECT pair, content_match_key, min(content_uri) AS u, arg_min(album, content_uri) AS a FROM rt GROUP BY 1, 2)
 SELECT fl.pair, fl.content_uri, CASE WHEN in_isrc AND in_name THEN 'isrc + name' WHEN in_isrc THEN 'isrc' WHEN in_name THEN 'name' END AS matched_tier,
 NOT (in_isrc OR in_name) AS is_absent, CASE WHEN in_isrc THEN ri.u ELSE rn.u END AS uri_other_side, CASE WHEN in_isrc THEN ri.a ELSE rn.a END AS album_other_side
 FROM fl LEFT JOIN ri ON ri.pair = fl.pair AND ri.isrc = fl.isrc LEFT JOIN rn ON rn.pair = fl.pair AND rn.content_match_key = fl.content_match_key WHERE NOT in_uri""")
def p5(spark, d):
    return pl.split_misses(*sides(spark, d), ["pair"]).select(
        "pair", "content_uri", "matched_tier", "is_absent", "uri_other_side", "album_other_side"
    )


@query("p6_tier_nesting", f"""WITH {_SIDES} SELECT pair, count(*) FILTER (NOT in_isrc AND in_uri) = 0 AS isrc_inside_uri, count(*) FILTER (NOT in_name AND in_uri) = 0 AS name_inside_uri,
 count(*) FILTER (NOT in_name AND in_isrc) = 0 AS name_inside_isrc, count(*) FILTER (NOT in_uri AND in_isrc) AS uri_not_isrc, count(*) FILTER (NOT in_isrc AND in_name) AS isrc_not_name FROM fl GROUP BY 1""")
def p6(spark, d):
    return pl.tier_nesting(*sides(spark, d), ["pair"])


@query("p7_overlap_metrics", f"""WITH {_SIDES}, z AS (SELECT playlist_id, count(*) AS n FROM now_ GROUP BY 1), x AS (SELECT lt.playlist_id AS l, rt.playlist_id AS r, count(*) AS c FROM lt JOIN rt USING (pair, content_uri) GROUP BY 1, 2),
 q AS (SELECT a.playlist_id AS left_id, b.playlist_id AS right_id, a.n AS left_size, b.n AS right_size, coalesce(c, 0) AS overlap FROM z a JOIN z b ON CAST(substr(b.playlist_id, 3) AS INT) = CAST(substr(a.playlist_id, 3) AS INT) + 1
  LEFT JOIN x ON x.l = a.playlist_id AND x.r = b.playlist_id)
 SELECT *, round(overlap * 1.0 / (left_size + right_size - overlap), 6) AS jaccard, round(overlap * 1.0 / left_size, 6) AS coverage, left_size - overlap AS left_misses FROM q""")
def p7(spark, d):
    now = latest(spark, d)
    after = F.concat(
        F.lit("pl"), (F.substring("playlist_id", 3, 20).cast("bigint") + 1).cast("string")
    )
    pairs = w.playlist_items(spark, d).select(
        F.col("playlist_id").alias("left_id"), after.alias("right_id")
    ).distinct()
    return pl.overlap_metrics(now, pairs).withColumns(
        {"jaccard": r("jaccard", 6), "coverage": r("coverage", 6)}
    )


_PK = "pk AS (SELECT row_number() OVER (ORDER BY playlist_id) AS k, playlist_id FROM (SELECT DISTINCT playlist_id FROM item))"


def _named(spark, d):
    k = F.col("playlist_key")
    return current_playlists(spark, d).select(
        "playlist_key", "playlist_id", "is_current",
        F.concat(F.lit("Mix’s "), F.col("playlist_id")).alias("playlist_name"),
        (k * 2).alias("track_total"), (k % 2 == 0).alias("is_owned_by_profile"),
        F.lit(False).alias("is_collaborative"), F.lit(True).alias("is_public"),
        F.to_timestamp(F.lit("2001-01-01")).alias("valid_from"),
    )


@query("p8_load_playlists", f"""WITH {o.MEMBERS}, {_PK} SELECT 'Mix’s ' || playlist_id AS playlist_name, k * 2 AS track_total, k % 2 = 0 AS is_owned_by_profile, '2001-01-01' AS first_seen, count(*) AS tracks_loaded
 FROM pk JOIN mem USING (playlist_id) WHERE k % 10 <> 0 GROUP BY ALL""")
def p8(spark, d):
    return pl.load_playlists(_named(spark, d), fct_membership(spark, d)).select(
        "playlist_name", "track_total", "is_owned_by_profile", day("first_seen"), "tracks_loaded"
    )


@query("p8_orphan_summary", f"""WITH {o.MEMBERS} SELECT count(*) AS membership_rows, count(*) FILTER (part % 9 = 0) AS rows_without_content, count(DISTINCT content_uri) AS distinct_tracks,
 count(DISTINCT content_uri) FILTER (part % 9 = 0) AS distinct_tracks_without_content FROM mem""")
def p8_orphans(spark, d):
    known = w.catalogue(spark, d).filter("(content_key - 1) % 9 <> 0")
    return pl.orphan_summary(w.membership(spark, d), known)


@query("p8_empty_playlists", f"""WITH {o.MEMBERS}, {_PK} SELECT playlist_id FROM pk WHERE k % 10 <> 0 AND playlist_id NOT IN (SELECT playlist_id FROM mem WHERE added_at >= DATE '2001-10-31')""")
def p8_empty(spark, d):
    """Playlists that have no member added lately."""
    late = fct_membership(spark, d).filter("added_at >= date '2001-10-31'")
    return pl.empty_playlists(_named(spark, d), late).select("playlist_id")


_NEEDLES = ("mix's supplier#000000003", "SUPPLIER#000000007", "0000001", "nobody", "mix’s supplier")
_NSQL = ", ".join("('" + n.replace("'", "''") + "')" for n in _NEEDLES)


@query("p9_name_matches", f"""WITH s AS (SELECT 'Mix’s ' || s_name AS n FROM supplier), a(needle) AS (VALUES {_NSQL}), f AS (SELECT needle, lower(replace(needle, '’', '''')) AS t FROM a),
 m AS (SELECT needle, count(*) FILTER (lower(replace(n, '’', '''')) = t) AS exact_names, count(*) FILTER (contains(lower(replace(n, '’', '''')), t)) AS loose_names,
  min(n) FILTER (lower(replace(n, '’', '''')) = t) AS en, min(n) FILTER (contains(lower(replace(n, '’', '''')), t)) AS ln FROM f, s GROUP BY 1)
 SELECT needle, exact_names, loose_names, CASE WHEN exact_names = 1 THEN en WHEN exact_names = 0 AND loose_names = 1 THEN ln END AS resolved, exact_names = 1 AS is_exact FROM m""")
def p9(spark, d):
    names = table(spark, d, "supplier").select(
        F.concat(F.lit("Mix’s "), "s_name").alias("playlist_name")
    )
    return pl.name_matches(names, _NEEDLES)


_TYPED = """ty AS (SELECT DISTINCT CASE c_custkey % 5 WHEN 0 THEN 'MIX''S supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') WHEN 1 THEN lpad(CAST(c_custkey % 1000 AS VARCHAR), 4, '0')
  WHEN 2 THEN CAST(c_custkey % 100 AS VARCHAR) WHEN 3 THEN c_name ELSE '’s Supplier#00000' || lpad(CAST(c_custkey // 5 % 10000 AS VARCHAR), 4, '0') END AS needle FROM customer)"""


@query("p9_resolve_names", f"""WITH {_TYPED}, s AS (SELECT 'Mix’s ' || s_name AS n, lower(replace('Mix’s ' || s_name, '’', '''')) AS fn FROM supplier), f AS (SELECT needle, lower(replace(needle, '’', '''')) AS t FROM ty),
 m AS (SELECT needle, count(*) FILTER (fn = t) AS exact_names, count(n) AS loose_names, min(n) FILTER (fn = t) AS en, min(n) AS ln FROM f LEFT JOIN s ON contains(fn, t) GROUP BY 1)
 SELECT needle, exact_names, loose_names, CASE WHEN exact_names = 1 THEN en WHEN exact_names = 0 AND loose_names = 1 THEN ln END AS resolved,
  CASE WHEN exact_names = 1 THEN 'exact' WHEN exact_names = 0 AND loose_names = 1 THEN 'only' WHEN loose_names = 0 THEN 'none' ELSE 'several' END AS outcome FROM m""")
def p9_resolve(spark, d):
    """What every customer may have typed: whole names, their numbers, two digits, other people's names."""
    key = F.col("c_custkey")
    padded = lambda c, n: F.lpad(c.cast("string"), n, "0")
    typed = F.when(key % 5 == 0, F.concat(F.lit("MIX'S supplier#"), padded(key, 9))).when(
        key % 5 == 1, padded(key % 1000, 4)).when(key % 5 == 2, (key % 100).cast("string")).when(
        key % 5 == 3, F.col("c_name")).otherwise(
        F.concat(F.lit("’s Supplier#00000"), padded(F.floor(key / 5) % 10_000, 4)))
    names = table(spark, d, "supplier").select(F.concat(F.lit("Mix’s "), "s_name").alias("playlist_name"))
    return pl.resolve_names(names, table(spark, d, "customer").select(typed.alias("needle")))


@query("p9_any_word_candidates", f"""WITH {o.MEMBERS}, {_PK} SELECT 'Mix’s ' || playlist_id AS playlist_name, k * 2 AS track_total, CAST(count(*) AS BIGINT) AS loaded FROM pk JOIN mem USING (playlist_id)
 WHERE k % 10 <> 0 AND ('Mix’s ' || playlist_id ILIKE '%pl12%' OR 'Mix’s ' || playlist_id ILIKE '%pl34%') GROUP BY ALL ORDER BY 3 DESC, 1 LIMIT 15""")
def p9_words(spark, d):
    return pl.any_word_candidates(_named(spark, d), fct_membership(spark, d), "pl12 or pl34")


_SHEET = f"""{o.MEMBERS}, {{star}}, s0 AS (SELECT *, row_number() OVER (PARTITION BY playlist_id ORDER BY position, {o.uri('part')}) AS order_number FROM mem WHERE snapshot_date = (SELECT max(snapshot_date) FROM mem)),
 ls AS (SELECT content_key, count(*) AS plays, sum(ms) AS ms, count(*) FILTER (qualified) AS q FROM pl WHERE profile_slug = 'p0' GROUP BY 1),
 gn AS (SELECT content_key, arg_min(genre_name, (CASE tag_type WHEN 'genre' THEN 0 ELSE 1 END, -vote_count, genre_name)) AS genre FROM bca JOIN bag USING (artist_key) WHERE is_primary GROUP BY 1)"""


def sheet(spark, d):
    members = latest(spark, d).select(
        "playlist_id", "position", "content_uri", (F.col("part") + 1).alias("content_key"),
        F.col("title").alias("content_name"), F.col("artist").alias("primary_creator_name"), "isrc",
        "added_at",
    )
    listening = pl.listening_of(w.plays(spark, d).filter("profile_slug = 'p0'"))
    genre = pl.best_genre(
        w.br_content_artist(spark, d), w.br_artist_genre(spark, d), w.dim_genre(spark, d)
    )
    albums = _dim_album(spark, d)
    details = star.dim_track_detail(w.tracks(spark, d), w.catalogue(spark, d), albums)
    own = w.catalogue(spark, d).filter("content_key % 2 = 0").select(
        "content_uri", F.lit(61_000).alias("duration_ms")
    )
    return pl.playlist_sheet(
        members, w.catalogue(spark, d), details, albums, own, listening, genre,
        playlist=["playlist_id"],
    )


@query("p10_playlist_sheet", f"""WITH {_SHEET.format(star=ALL)} SELECT s0.playlist_id, order_number, CAST(s0.part AS VARCHAR) AS track_id, title AS song, artist, genre, coalesce(plays, 0) AS plays, coalesce(q, 0) AS qualified_plays,
 coalesce(round(CAST(ms AS DOUBLE) / 60000, 1), 0.0) AS minutes, CASE WHEN cat.content_key % 2 = 0 THEN '1:01' WHEN duration_ms IS NULL THEN '' ELSE (duration_ms // 60000) || ':' || lpad(CAST(duration_ms // 1000 % 60 AS VARCHAR), 2, '0') END AS duration,
 p_size % 2 = 0 AND is_resolved AND s0.part % 10 > 1 AS explicit FROM s0 JOIN cat USING (part) LEFT JOIN ls USING (content_key) LEFT JOIN gn USING (content_key)""")
def p10(spark, d):
    return sheet(spark, d).select(
        "playlist_id", "order_number", "track_id", "song", "artist", "genre", "plays",
        "qualified_plays", "minutes", "duration",
        F.coalesce("explicit", F.lit(False)).alias("explicit"),
    )


@query("p11_sheet_coverage", f"""WITH {_SHEET.format(star=ALL)}, x AS (SELECT s0.*, genre FROM s0 JOIN cat USING (part) LEFT JOIN gn USING (content_key)), y AS (SELECT 'genre' AS "column", count(genre) AS populated, count(*) AS "of" FROM x
 UNION ALL SELECT 'song', count(title), count(*) FROM x UNION ALL SELECT 'duration', count(*) FILTER (duration_ms IS NOT NULL OR cat.content_key % 2 = 0), count(*) FROM s0 JOIN cat USING (part)) SELECT *, round(100.0 * populated / "of", 0) AS pct FROM y""")
def p11(spark, d):
    return pl.sheet_coverage(sheet(spark, d)).filter(
        F.col("column").isin("genre", "song", "duration")
    )


_FILLED = {
    **dict.fromkeys(("playlist_id", "order_number", "track_id", "plays", "qualified_plays", "minutes", "resolved"), "TRUE"),
    "song": "trim(title) <> ''", "artist": "trim(artist) <> ''", "genre": "genre IS NOT NULL", "added_at": "added_at IS NOT NULL",
    **dict.fromkeys(("duration", "duration_ms"), "duration_ms IS NOT NULL OR content_key % 2 = 0"),
    **dict.fromkeys(("first_played", "last_played"), "plays IS NOT NULL"),
    **dict.fromkeys(("album", "year", "explicit", "track_no", "album_type"), "described"),
    "isrc": "isrc IS NOT NULL OR described AND part % 17 <> 0",
}
_COUNTED = " UNION ALL ".join(
    f"""SELECT '{name}' AS "column", count(*) FILTER ({rule}) AS populated, count(*) AS "of" FROM x""" for name, rule in _FILLED.items()
)


@query("p11_sheet_coverage_all", f"""WITH {_SHEET.format(star=ALL)}, x AS (SELECT s0.*, cat.content_key, duration_ms, genre, plays, is_resolved AND s0.part % 10 > 1 AS described
  FROM s0 JOIN cat USING (part) LEFT JOIN gn USING (content_key) LEFT JOIN ls USING (content_key)), y AS ({_COUNTED}) SELECT *, round(100.0 * populated / "of", 0) AS pct FROM y""")
def p11_all(spark, d):
    """Every column of the sheets of all playlists."""
    return pl.sheet_coverage(sheet(spark, d))


# --- extracts -------------------------------------------------------------------------------------

OPTS = ExtractOptions()
_PUB = f"""{ALL}, inc AS (SELECT DISTINCT profile_slug, content_uri, ended FROM ex WHERE was_incognito),
pu AS (SELECT p.* , b.artist_key FROM pl p LEFT JOIN (SELECT content_key, artist_key FROM bca WHERE is_primary) b USING (content_key)
  WHERE NOT EXISTS (SELECT 1 FROM inc WHERE inc.profile_slug = p.profile_slug AND inc.content_uri = p.content_uri AND inc.ended = p.ended)),
bw AS (SELECT artist_key, bucket_name, sum(w) AS weight FROM bag JOIN gmap USING (genre_key) WHERE tag_type = 'genre' GROUP BY 1, 2),
pd AS (SELECT profile_slug, full_date, content_type, conn_country, platform, coalesce(bucket_name, 'unclassified') AS bucket_name, qualified, ms, coalesce(weight, 1.0) AS weight FROM pu LEFT JOIN bw USING (artist_key))"""
_DAILY = """count(*) AS plays, count(*) FILTER (qualified) AS qualified_plays, CAST(sum(ms) AS BIGINT) AS ms_played, count(ms) AS rows_with_duration,
 round(sum(weight), 4) AS allocated_plays, round(sum(ms * weight), 2) AS allocated_ms"""


def published(spark, d, opts=OPTS):
    return pb.published_plays(
        w.fact(spark, d), w.profiles(spark), w.catalogue(spark, d), w.br_content_artist(spark, d),
        w.dim_date(spark), w.history(spark, d).filter("source_system = 'export'"), opts,
    )


def daily(spark, d, opts=OPTS):
    return pb.plays_daily(
        published(spark, d, opts), w.br_artist_genre(spark, d), w.bucket_map(spark, d), opts
    )


def _sums(spark, d):
    """Sums of the published plays, written once for all extracts that read them, and the daily extract."""
    sums = pinned(pb.published_sums(published(spark, d)))
    return sums, pb.plays_daily(sums, w.br_artist_genre(spark, d), w.bucket_map(spark, d), OPTS)


@query("q1_plays_daily", f"""WITH {_PUB} SELECT profile_slug, CAST(full_date AS VARCHAR) AS play_date, content_type, bucket_name, {_DAILY} FROM pd GROUP BY 1, 2, 3, 4""")
def q1(spark, d):
    return daily(spark, d).withColumns(
        {"play_date": day("play_date"), "allocated_plays": r("allocated_plays"),
         "allocated_ms": r("allocated_ms", 2)}
    )


@query("q2_platform_family_daily", f"""WITH {_PUB} SELECT profile_slug, CAST(full_date AS VARCHAR) AS play_date, content_type, bucket_name, conn_country, {o.FAMILY} AS platform_family, {_DAILY} FROM pd GROUP BY 1, 2, 3, 4, 5, 6""")
def q2(spark, d):
    opts = ExtractOptions(include_conn_country=True, include_platform_family=True)
    return daily(spark, d, opts).withColumns(
        {"play_date": day("play_date"), "allocated_plays": r("allocated_plays"),
         "allocated_ms": r("allocated_ms", 2)}
    )


@query("q3_artists", f"""WITH {_PUB} SELECT profile_slug, yr AS year, coalesce(artist_name, '(unidentified)') AS artist_name, artist_key IS NOT NULL AS is_identified, count(*) AS plays,
 count(*) FILTER (qualified) AS qualified_plays, round(CAST(sum(ms) AS DOUBLE) / 3600000, 3) AS hours, count(ms) AS rows_with_duration FROM pu LEFT JOIN da USING (artist_key) WHERE content_type = 'track' GROUP BY 1, 2, 3, 4""")
def q3(spark, d):
    return pb.artists(published(spark, d), w.dim_artist(spark, d))


_GEN = """ge AS (SELECT profile_slug, CAST(date_trunc('month', full_date) AS DATE) AS month_start, bucket_name, sum(weight) AS ap, sum(ms * weight) AS am FROM pd WHERE content_type = 'track' GROUP BY 1, 2, 3)"""


@query("q4_genres", f"""WITH {_PUB}, {_GEN} SELECT profile_slug, CAST(month_start AS VARCHAR) AS month_start, bucket_name, round(ap, 4) AS allocated_plays, round(am, 2) AS allocated_ms,
 round(am / nullif(sum(am) OVER (PARTITION BY profile_slug, month_start), 0), 6) AS share_of_music_ms FROM ge""")
def q4(spark, d):
    return pb.genres(daily(spark, d)).select(
        P, day("month_start"), "bucket_name", r("allocated_plays"), r("allocated_ms", 2),
        "share_of_music_ms",
    )


_STEPS = """ps AS (SELECT profile_slug, CASE WHEN content_type <> 'track' THEN 1 WHEN artist_key IS NULL THEN 2 WHEN artist_key NOT IN (SELECT artist_key FROM bw) THEN 3 ELSE 4 END AS depth, ms FROM pu),
pst AS (SELECT profile_slug, n AS step_number, count(*) AS published_play_count, CAST(sum(ms) AS BIGINT) AS published_ms_played, count(ms) AS published_rows_with_duration FROM ps, (VALUES (1),(2),(3),(4)) v(n) WHERE depth >= n GROUP BY 1, 2)"""


@query("q5_published_steps", f"WITH {_PUB}, {_STEPS} SELECT * FROM pst")
def q5(spark, d):
    return pb.published_steps(
        published(spark, d), w.br_artist_genre(spark, d), w.bucket_map(spark, d), OPTS
    )


@query("q6_coverage", f"""WITH {_PUB}, {_STEPS} SELECT profile_slug, step_number, step_name, play_count, ms_played, published_play_count, published_ms_played FROM rec LEFT JOIN pst USING (profile_slug, step_number)""")
def q6(spark, d):
    published_ = pb.published_steps(
        published(spark, d), w.br_artist_genre(spark, d), w.bucket_map(spark, d), OPTS
    )
    return pb.coverage(steps(spark, d), published_).select(
        P, "step_number", "step_name", "play_count", "ms_played", "published_play_count",
        "published_ms_played",
    )


@query("q7_manifest", f"""WITH {_PUB}, {_GEN} SELECT 'plays_daily' AS extract, count(*) AS rows, CAST(min(full_date) AS VARCHAR) AS first_date, CAST(max(full_date) AS VARCHAR) AS last_date FROM (SELECT DISTINCT profile_slug, full_date, content_type, bucket_name FROM pd)
 UNION ALL SELECT 'genres', count(*), CAST(min(month_start) AS VARCHAR), CAST(max(month_start) AS VARCHAR) FROM ge
 UNION ALL SELECT 'artists', count(*), min(yr) || '-01-01', max(yr) || '-12-31' FROM (SELECT DISTINCT profile_slug, yr, artist_key FROM pu WHERE content_type = 'track')""")
def q7(spark, d):
    sums, own = _sums(spark, d)
    extracts = {
        "plays_daily": own, "genres": pb.genres(own),
        "artists": pb.artists(sums, w.dim_artist(spark, d)),
    }
    return pb.extract_summary(extracts).select("extract", "rows", day("first_date"), day("last_date"))


def _extracts(spark, d):
    """The four tables that are published."""
    sums, own = _sums(spark, d)
    weights = (w.br_artist_genre(spark, d), w.bucket_map(spark, d), OPTS)
    return {
        "plays_daily": own, "artists": pb.artists(sums, w.dim_artist(spark, d)),
        "genres": pb.genres(own),
        "coverage": pb.coverage(steps(spark, d), pb.published_steps(sums, *weights)),
    }


@query("a7_write_extracts", f"""WITH {_PUB}, {_GEN}, {_STEPS} SELECT 'plays_daily' AS extract, count(*) AS rows, CAST(min(full_date) AS VARCHAR) AS first_date, CAST(max(full_date) AS VARCHAR) AS last_date FROM (SELECT DISTINCT profile_slug, full_date, content_type, bucket_name FROM pd)
 UNION ALL SELECT 'genres', count(*), CAST(min(month_start) AS VARCHAR), CAST(max(month_start) AS VARCHAR) FROM ge
 UNION ALL SELECT 'artists', count(*), min(yr) || '-01-01', max(yr) || '-12-31' FROM (SELECT DISTINCT profile_slug, yr, artist_key FROM pu WHERE content_type = 'track')
 UNION ALL SELECT 'coverage', count(*), NULL, NULL FROM rec LEFT JOIN pst USING (profile_slug, step_number)""")
def a7(spark, d):
    """Written as files, and summarised from what the files hold."""
    out = pb.write_extracts(_extracts(spark, d), f"{shared_dir(spark)}/extracts-{uuid.uuid4().hex}")
    return out.select("extract", "rows", day("first_date"), day("last_date"))


_PUBLISHED = {
    "plays_daily": "profile_slug play_date content_type bucket_name plays qualified_plays ms_played rows_with_duration allocated_plays allocated_ms",
    "genres": "profile_slug month_start bucket_name allocated_plays allocated_ms share_of_music_ms",
    "artists": "profile_slug year artist_name is_identified plays qualified_plays hours rows_with_duration",
}


@query("q7_manifest_columns", "SELECT * FROM (VALUES " + ", ".join(
    f"('{name}.csv', '{c}', 'yes')" for name, columns in _PUBLISHED.items() for c in columns.split()
) + """) v(file, "column", included) WHERE EXISTS (SELECT 1 FROM lineitem) UNION ALL SELECT '(all)', x, 'NO' FROM (VALUES ('platform (raw)'), ('incognito plays'), ('conn_country'),
 ('artist_id / content_uri'), ('profile_slug (other people)'), ('display_name / user_id / email')) e(x)""")
def q7_columns(spark, d):
    """What every published column is and where it comes from; none is left without a source."""
    found = pb.manifest(spark, {k: v for k, v in _extracts(spark, d).items() if k != "coverage"})
    return found.filter((F.col("source") != "") & (F.col("source") != pb.DERIVED)).select("file", "column", "included")


def _filled(table, extract, columns):
    return " UNION ALL ".join(
        f"SELECT '{extract}.csv' AS file, '{name}' AS \"column\", 'yes' AS included, '{pb.SOURCES[name]}' AS source, '{pb.NOTES.get(name, '').replace(chr(39), chr(39) * 2)}' AS note, count(*) AS rows, count({sql}) AS filled FROM {table}"
        for name, sql in columns.items())


@query("q7_manifest_of_files", f"""WITH {_PUB}, {_GEN}, ar AS (SELECT profile_slug, yr, coalesce(artist_name, '(unidentified)') AS artist_name, artist_key IS NOT NULL AS known, count(*) AS plays, count(*) FILTER (qualified) AS q, sum(ms) AS ms, count(ms) AS timed
  FROM pu LEFT JOIN da USING (artist_key) WHERE content_type = 'track' GROUP BY 1, 2, 3, 4) """ + _filled("ar", "artists", {
    "profile_slug": "profile_slug", "year": "yr", "artist_name": "artist_name", "is_identified": "known", "plays": "plays",
    "qualified_plays": "q", "hours": "ms", "rows_with_duration": "timed"}) + " UNION ALL " + _filled("ge", "genres", {
    "profile_slug": "profile_slug", "month_start": "month_start", "bucket_name": "bucket_name", "allocated_plays": "ap", "allocated_ms": "am",
    "share_of_music_ms": "am / nullif((SELECT sum(x.am) FROM ge x WHERE x.profile_slug = ge.profile_slug AND x.month_start = ge.month_start), 0)"})
    + " UNION ALL SELECT '(all)', field, 'NO', source, why, NULL, NULL FROM (VALUES " + ", ".join(
        "('" + "', '".join(x.replace("'", "''") for x in row) + "')" for row in pb.EXCLUDED) + ") v(field, source, why)")
def q7_files(spark, d):
    """Every column of two extracts as their files hold it: source, note, rows and how many are filled."""
    some = {k: v for k, v in _extracts(spark, d).items() if k in ("artists", "genres")}
    return pb.written_manifest(some, f"{shared_dir(spark)}/manifest-{uuid.uuid4().hex}")


@query("c8_incognito_anti_join", f"""WITH {_PUB} SELECT profile_slug, count(*) AS published FROM pu GROUP BY 1""")
def c8(spark, d):
    return published(spark, d).groupBy(P).agg(F.count(F.lit(1)).alias("published"))
