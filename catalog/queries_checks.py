"""Data-quality checks over the tables, with violations seeded by rule so results are not empty."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalog import oracle as o
from catalog import world as w
from catalog.base import query, r, stamp, table
from catalog.queries_events import _poll_rows, _token_rows, raw_export
from catalog.queries_history import dim_profile
from catalog.queries_listening import ALL, REC, steps
from playmart.operators.ordered import ranked
from playmart.plans import checks as ck
from playmart.plans.events import dedupe_play_events
from playmart.session import shared_dir, shuffle_partitions, small_table
from playmart.sources import readers as rd, staging, writers as wr

P = "profile_slug"


@query("m1_not_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def m1(spark, d):
    return ck.not_unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("m2_nulls", f"WITH {o.CATALOGUE} SELECT content_key FROM cat WHERE creator IS NULL")
def m2_nulls(spark, d):
    return ck.nulls_in(w.catalogue(spark, d), "primary_creator_name").select("content_key")


@query("m2_accepted_values", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1")
def m2_values(spark, d):
    return ck.unexpected_values(table(spark, d, "orders"), "o_orderstatus", ["F", "O"])


@query("m2_relationships", "SELECT l_partkey AS p_partkey, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <> 7) GROUP BY 1")
def m2_links(spark, d):
    parents = table(spark, d, "part").filter("p_size <> 7")
    return ck.orphans(table(spark, d, "lineitem"), "l_partkey", parents, "p_partkey")


@query("m3_fact_grain", f"""WITH {o.EVENT_FACT} SELECT profile_key, content_key, strftime(date_trunc('second', ended), '%Y-%m-%d %H:%M:%S') AS second, count(*) AS n FROM ef
 JOIN (VALUES (1), (2)) v(c) ON c = 1 OR ef.play_event_key % 50 = 0 GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def m3(spark, d):
    fact = w.event_fact(spark, d)
    seeded = fact.unionByName(fact.filter("play_event_key % 50 = 0"))
    return ck.fact_grain(seeded).select("profile_key", "content_key", stamp("second"), "n")


@query("m4_dedupe_rules", f"""WITH {o.EVENTS}, mn AS (SELECT profile_slug, content_uri, minute_ AS m, count(*) FILTER (source_system = 'api') AS a, count(*) FILTER (source_system = 'export') AS e FROM rk GROUP BY 1, 2, 3),
 x AS (SELECT profile_slug, content_uri, m AS at_, 'api/api minute' AS rule FROM mn WHERE a > 1 UNION ALL SELECT profile_slug, content_uri, m, 'export/api minute' FROM mn WHERE a > 0 AND e > 0
 UNION ALL SELECT profile_slug, content_uri, ended, 'export/export second' FROM rk WHERE source_system = 'export' GROUP BY 1, 2, 3 HAVING count(*) > 1)
 SELECT profile_slug, content_uri, strftime(at_, '%Y-%m-%d %H:%M:%S') AS "at", rule FROM x""")
def m4(spark, d):
    return ck.dedupe_rules(w.event_plays(spark, d)).withColumn("at", stamp("at"))


@query("m4_dedupe_rules_hold", f"""WITH {o.EVENTS} SELECT profile_slug FROM dd WHERE FALSE""")
def m4_hold(spark, d):
    return ck.dedupe_rules(dedupe_play_events(w.event_plays(spark, d))).select(P)


@query("m5_star_orphans", f"""WITH {o.PLAYS} SELECT 'fact.content' AS link, CAST(content_key AS VARCHAR) AS "key", count(*) AS n FROM pl WHERE content_key % 100 = 0 GROUP BY 2
 UNION ALL SELECT 'fact.profile', CAST(profile_key AS VARCHAR), count(*) FROM pl WHERE profile_key = 3 GROUP BY 2""")
def m5(spark, d):
    fact = w.fact(spark, d)
    return ck.star_orphans(
        [
            ("fact.content", fact, "content_key", w.catalogue(spark, d).filter("content_key % 100 <> 0"), "content_key"),
            ("fact.profile", fact, "profile_key", w.profiles(spark).filter("profile_key <> 3"), "profile_key"),
            ("fact.date", fact, "date_key", w.dim_date(spark), "date_key"),
        ]
    )


@query("m6_chain_breaks", f"WITH {REC} SELECT profile_slug, step_number FROM rec WHERE step_number = 3 AND profile_slug = 'p2'")
def m6(spark, d):
    bent = steps(spark, d).withColumn(
        "residual_play_count",
        F.col("residual_play_count")
        + F.when((F.col("step_number") == 3) & (F.col(P) == "p2"), 1).otherwise(0),
    )
    return ck.chain_breaks(bent).select(P, "step_number")


@query("m7_first_step_mismatch", f"""WITH {o.HIST}, a AS (SELECT profile_slug, count(*) AS play_count FROM hist GROUP BY 1) SELECT profile_slug, play_count, CASE WHEN profile_slug <> 'p4' THEN play_count - 1 END AS fact_plays FROM a
 WHERE profile_slug IN ('p1', 'p4')""")
def m7(spark, d):
    fact = w.fact(spark, d).filter("profile_key <> 5")
    one = fact.filter("profile_key = 2").agg(F.min("play_event_key")).scalar()
    return ck.first_step_mismatch(
        steps(spark, d), fact.filter(F.col("play_event_key") != one), w.profiles(spark)
    )


@query("m8_allocation_mismatch", f"WITH {ALL} SELECT profile_slug FROM rec WHERE step_number = 4 AND profile_slug = 'p3'")
def m8(spark, d):
    short = w.bucket_allocation(spark, d).filter("not (profile_slug = 'p3' and year = 1998)")
    return ck.allocation_mismatch(steps(spark, d), short).select(P)


@query("m9_other_share", f"""WITH {ALL}, s AS (SELECT sum(allocated_ms) FILTER (bucket_name = 'other') AS o, sum(allocated_ms) AS t FROM alloc) SELECT round(o / t, 6) AS share FROM s WHERE o / t > 0.01""")
def m9(spark, d):
    return ck.other_share(w.bucket_allocation(spark, d), limit=0.01).select(r("share", 6))


@query("m10_weights_off", f"WITH {o.CATALOGUE}, {o.STAR} SELECT artist_key, tag_type, round(sum(w), 6) AS total FROM bag WHERE genre_key % 5 <> 0 GROUP BY 1, 2 HAVING abs(sum(w) - 1) > 1e-6")
def m10(spark, d):
    return ck.weights_off(w.br_artist_genre(spark, d).filter("genre_key % 5 <> 0")).withColumn(
        "total", r("total", 6)
    )


@query("m12_access_mismatch", """WITH tok AS (SELECT 'p' || (o_custkey % 5) AS profile_slug, arg_max(o_orderkey % 3 <> 0, (o_orderdate, o_orderkey)) AS t FROM orders GROUP BY 1)
 SELECT profile_slug, NOT t AS has_api_access, t AS expected FROM tok WHERE profile_slug <> 'p0'""")
def m12(spark, d):
    wrong = dim_profile(spark, d).withColumn(
        "has_api_access",
        F.when(F.col(P) == "p0", F.col("has_api_access")).otherwise(~F.col("has_api_access")),
    )
    return ck.access_mismatch(
        wrong, staging.api_access_observation(_token_rows(spark, d)),
        staging.poll_run(_poll_rows(spark, d)),
    )


@query("m13_unregistered_profiles", "SELECT DISTINCT 'p' || (o_custkey % 5) AS profile_slug FROM orders WHERE o_custkey % 5 IN (1, 4)")
def m13(spark, d):
    known = w.registry(spark).filter("profile_slug not in ('p1', 'p4')")
    return ck.unregistered_profiles(w.history(spark, d), known)


def _twins(spark, d):
    """Every profile's records, with p3's also stored under another name."""
    h = w.history(spark, d).select(P, "content_uri", "ended_at_utc", "raw_response_id")
    return h.unionByName(h.filter("profile_slug = 'p3'").withColumn(P, F.lit("p9")))


@query("m14_identical_profiles", "SELECT 'p3' AS profile_slug, 'p9' AS twin, count(*) AS row_count FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 5 = 3")
def m14(spark, d):
    return ck.identical_profiles(_twins(spark, d), ["content_uri", "ended_at_utc"])


@query("m15_slow_loads", f"""WITH {o.HIST} SELECT profile_slug, source_file FROM hist GROUP BY 1, 2 HAVING date_diff('second', min(ended), max(ended)) > 60""")
def m15(spark, d):
    return ck.slow_loads(w.history(spark, d)).select(P, "source_file")


@query("m16_personal_keys", f"WITH {o.HIST} SELECT raw_id AS record_index FROM hist WHERE source_system = 'export' AND raw_id % 500 = 1")
def m16(spark, d):
    raw = raw_export(spark, d)
    seeded = raw.withColumn(
        "payload",
        F.when(F.col("record_index") % 500 == 1,
               F.concat(F.lit('{"ip_addr":"x",'), F.expr("substring(payload, 2)"))).otherwise(F.col("payload")),
    )
    return ck.personal_keys(seeded).select("record_index")


@query("m17_profile_overlaps", f"""WITH {o.HIST}, b AS (SELECT DISTINCT p, k FROM (SELECT profile_slug AS p, content_uri || strftime(ended, '%Y-%m-%d %H:%M:%S') AS k FROM hist
   UNION ALL SELECT 'copy', content_uri || strftime(ended, '%Y-%m-%d %H:%M:%S') FROM hist WHERE profile_slug = 'p1' AND raw_id % 10 <> 3)),
 z AS (SELECT p, count(*) AS n FROM b GROUP BY 1) SELECT a.p AS left_profile, c.p AS right_profile, (SELECT count(*) FROM b x JOIN b y ON x.k = y.k WHERE x.p = a.p AND y.p = c.p) AS shared,
 round((SELECT count(*) FROM b x JOIN b y ON x.k = y.k WHERE x.p = a.p AND y.p = c.p) * 1.0 / least(a.n, c.n), 6) AS share, a.p = 'copy' AND c.p = 'p1' AS refused FROM z a JOIN z c ON a.p = 'copy' AND c.p <> 'copy'""")
def m17(spark, d):
    """A newly loaded profile against those already there; most of its plays are another's."""
    h = w.history(spark, d).select(P, "content_uri", "ended_at_utc", "raw_response_id")
    new = h.filter("profile_slug = 'p1' and raw_response_id % 10 <> 3").withColumn(P, F.lit("copy"))
    pairs = small_table(
        spark, [("copy", slug) for slug, _, _ in w.PROFILES], "left_id string, right_id string"
    )
    plays = h.unionByName(new).drop("raw_response_id")
    return ck.profile_overlaps(plays, ["ended_at_utc", "content_uri"], pairs).withColumn(
        "share", r("share", 6)
    )


@query("a11_append_guard", """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN ['status'] WHEN o_orderkey % 11 = 0 THEN ['ok needs a response'] END AS broken FROM orders
 WHERE o_orderstatus = 'P' OR o_orderkey % 11 = 0""")
def a11(spark, d):
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(
        key.alias("id"),
        F.when(F.col("o_orderstatus") == "P", "odd").when(F.col("o_orderstatus") == "F", "error")
        .otherwise("ok").alias("status"),
        F.when((F.col("o_orderstatus") == "O") != ((key % 11 == 0) & (F.col("o_orderstatus") != "P")), key).alias("raw_id"),
    )
    return wr.broken_rules(rows, wr.poll_rules()).select("id", "broken")


@query("a10_scrub_export_record", f"WITH {o.HIST} SELECT count(*) AS records, 0 AS with_address FROM hist WHERE source_system = 'export'")
def a10(spark, d):
    from playmart.sources.scrub import scrub_export_record

    raw = raw_export(spark, d).withColumns({"ip_addr": F.lit("1.2.3.4"), "user_agent": F.lit("x")})
    clean = scrub_export_record(raw)
    return clean.agg(
        F.count(F.lit(1)).alias("records"),
        F.lit(sum(c in clean.columns for c in ("ip_addr", "user_agent"))).alias("with_address"),
    )


@query("a9_scrub_payload", """WITH p AS (SELECT l_suppkey AS s, count(*) AS n FROM lineitem GROUP BY 1) SELECT 'pl' || s AS id, s % 3 = 0 AS is_owned_by_profile, 'user' AS owner_type, 'items[].images,items[].owner.display_name,items[].owner.id' AS removed FROM p""")
def a9(spark, d):
    from playmart.sources.scrub import scrub_payload

    s = F.col("l_suppkey")
    ids = table(spark, d, "lineitem").groupBy("l_suppkey").count()
    entry = F.struct(
        F.concat(F.lit("pl"), w.text(s)).alias("id"),
        F.struct(
            F.when(s % 3 == 0, "me").otherwise("other").alias("id"), F.lit("Someone").alias("display_name"),
            F.lit("user").alias("type"),
        ).alias("owner"),
        F.array(F.lit("http://image")).alias("images"),
    )
    docs = ids.select(F.struct(F.array(entry).alias("items")).alias("doc"))
    clean, removed = scrub_payload(docs, "doc", "playlist", F.lit("me"))
    return clean.select(F.explode("doc.items").alias("p")).select(
        "p.id", "p.is_owned_by_profile", F.col("p.owner.type").alias("owner_type"),
        F.lit(",".join(removed)).alias("removed"),
    )


@query("a9_scrub_raw_json", """SELECT 'pl' || s_suppkey AS id, NULL AS private, 'user' AS owner_type, s_suppkey % 7 AS unknown_key, 'kept' AS unknown_below, '2001-01-01' AS added_at, 'DE' AS country FROM supplier""")
def a9_raw(spark, d):
    """Raw payloads of three feeds: the private paths go, keys nobody declared stay."""
    from playmart.sources.scrub import scrub_json

    s = F.col("s_suppkey")
    owner = F.struct(
        *[F.lit("x").alias(k) for k in ("id", "display_name", "uri", "href", "external_urls")],
        F.lit("user").alias("type"), F.struct(F.lit("kept").alias("deep")).alias("new"),
    )
    item = F.struct(F.concat(F.lit("pl"), w.text(s)).alias("id"), owner.alias("owner"),
                    F.array(F.lit("http://image")).alias("images"), (s % 7).alias("surprise"))
    added = F.struct(F.lit("2001-01-01").alias("added_at"), F.struct(F.lit("x").alias("id")).alias("added_by"))
    raw = table(spark, d, "supplier").select(
        scrub_json(F.to_json(F.struct(F.array(item).alias("items"))), "playlist").alias("lists"),
        scrub_json(F.to_json(F.struct(F.array(added).alias("items"))), "playlist_item").alias("items"),
        scrub_json(F.to_json(F.struct(F.lit("me@x").alias("email"), F.lit("DE").alias("country"))), "me").alias("me"),
    )
    at = lambda c, path: F.get_json_object(c, path)
    private = [at("lists", f"$.items[0].owner.{k}") for k in ("id", "display_name", "uri", "href", "external_urls")]
    return raw.select(
        at("lists", "$.items[0].id").alias("id"),
        F.coalesce(*private, at("lists", "$.items[0].images"), at("items", "$.items[0].added_by"), at("me", "$.email")).alias("private"),
        at("lists", "$.items[0].owner.type").alias("owner_type"), at("lists", "$.items[0].surprise").cast("bigint").alias("unknown_key"),
        at("lists", "$.items[0].owner.new.deep").alias("unknown_below"), at("items", "$.items[0].added_at").alias("added_at"),
        at("me", "$.country").alias("country"),
    )


@query("a13_backfill_feed", """SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'me' WHEN o_orderkey % 3 = 1 THEN 'track' ELSE 'playlist' END AS feed, count(*) AS rows FROM orders GROUP BY 1""")
def a13(spark, d):
    n = F.col("o_orderkey") % 3
    raw = table(spark, d, "orders").select(
        F.concat(F.when(n == 0, "me/").when(n == 1, "tracks/").otherwise("me_playlists/"), w.text("o_orderkey")).alias("source_file")
    )
    patterns = {"me": "me/%", "track": "tracks/%", "playlist": "me\\_playlists/%"}
    return wr.backfill_feed(raw, patterns).groupBy("feed").agg(F.count(F.lit(1)).alias("rows"))


@query("a13_backfill_checked", """SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'me' WHEN o_orderkey % 3 = 1 THEN 'track' ELSE 'playlist' END AS feed, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS ids, CAST(sum(length(o_orderstatus || o_orderpriority)) AS BIGINT) AS payload_chars FROM orders GROUP BY 1""")
def a13_checked(spark, d):
    """Old captures written, backfilled beside, compared column for column, and read from there."""
    n = F.col("o_orderkey") % 3
    base = f"{shared_dir(spark)}/backfill-{uuid.uuid4().hex}"
    table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat("o_orderstatus", "o_orderpriority").alias("payload"),
        F.concat(F.when(n == 0, "me/").when(n == 1, "tracks/").otherwise("me_playlists/"), w.text("o_orderkey")).alias("source_file"),
    ).write.parquet(f"{base}/now")
    patterns = {"me": "me/%", "track": "tracks/%", "playlist": "me\\_playlists/%"}
    done = spark.read.parquet(wr.backfill_checked(spark, f"{base}/now", f"{base}/next", patterns))
    return done.groupBy("feed").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"), F.sum(F.char_length("payload")).alias("payload_chars")
    )


@query("a12_rebuild_with_control", f"""WITH {o.HIST} SELECT profile_slug, count(*) AS rows, count(*) FILTER (profile_slug <> 'p0' AND raw_id % 1000 = 1) AS moved FROM hist GROUP BY 1""")
def a12_rebuild(spark, d):
    """A rebuild that changes every profile but the control: its path is handed over."""
    base = f"{shared_dir(spark)}/rebuild-{uuid.uuid4().hex}"
    h = w.history(spark, d).select(P, "content_uri", "ended_at_utc", "raw_response_id")
    h.write.partitionBy(P).parquet(f"{base}/now")
    changed = (F.col(P) != "p0") & (F.col("raw_response_id") % 1000 == 1)
    rebuilt = h.withColumn("content_uri", F.when(changed, F.lit("moved")).otherwise(F.col("content_uri")))
    path = wr.rebuild_with_control(
        spark, f"{base}/now", rebuilt, f"{base}/next", "p0", [P], ["content_uri", "ended_at_utc", "raw_response_id"]
    )
    return spark.read.parquet(path).groupBy(P).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("content_uri") == "moved").alias("moved"))


@query("a12_rebuild_fingerprints", "SELECT 'p' || (o_custkey % 5) AS profile_slug FROM orders WHERE o_custkey % 5 = 2 GROUP BY 1")
def a12(spark, d):
    h = w.history(spark, d).select(P, "content_uri", "ended_at_utc", "raw_response_id")
    after = h.filter("not (profile_slug = 'p2' and raw_response_id % 1000 = 1)")
    values = ["content_uri", "ended_at_utc"]
    return wr.changed_fingerprints(
        wr.fingerprint(h, [P], values), wr.fingerprint(after, [P], values), [P]
    )


@query("a2_new_export_records", f"""WITH {o.HIST}, e AS (SELECT DISTINCT profile_slug, source_file, raw_id FROM hist WHERE source_system = 'export')
 SELECT profile_slug, source_file, raw_id AS record_index FROM e WHERE source_file <> 'history_1996.json' AND raw_id % 4 = 1""")
def a2(spark, d):
    from playmart.sources.readers import new_export_records

    # hardly a row repeats; dealt out first, no task merges many partitions and holds all their keys
    incoming = w.history(spark, d).filter("source_system = 'export'").select(
        P, "source_file", F.col("raw_response_id").alias("record_index")
    ).repartition(shuffle_partitions(spark), P, "source_file", "record_index").distinct()
    stored = incoming.filter("source_file = 'history_1996.json' or record_index % 4 <> 1")
    return new_export_records(incoming, stored)


def _export_folders(spark, d):
    """Exports as several files a year, each one JSON array, with personal keys: profile -> folder, in one pass.

    A file is written record by record, so no task holds one.
    """
    fs = spark._jvm.org.apache.hadoop.fs
    base = f"{shared_dir(spark)}/export-{uuid.uuid4().hex}"
    # never null: rows without a profile go to a folder of their own, and the order of the rows is left alone
    records = raw_export(spark, d).select(
        F.coalesce(P, F.lit("")).alias(P), F.concat_ws("_", F.regexp_extract("source_file", "[0-9]+", 0), w.text(F.pmod("record_index", F.lit(8)))).alias("year"), "record_index",
        F.concat(F.lit('{"ip_addr":"1.2.3.4","user_agent":"x",'), F.expr("substring(payload, 2)")).alias("payload"),
    )
    by_file, place = [P, "year"], ["record_index", "payload"]
    spot = Window.partitionBy(*by_file).orderBy(*place)
    begins = F.when(F.row_number().over(spot) == 1, "[").otherwise(",")
    ends = F.when(F.lead(F.lit(1)).over(spot).isNull(), "]").otherwise("")
    listed = records.withColumns({"begins": begins, "ends": ends}).sortWithinPartitions(*by_file, *place)
    listed.select(F.concat("begins", "payload", "ends").alias("value"), *by_file).write.partitionBy(*by_file).text(f"{base}/parts")
    system = fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())

    def below(path):
        return [f.getPath() for f in system.listStatus(path)]

    folders = {profile: f"{base}/files/{profile}" for profile, *_ in w.PROFILES}
    for folder in folders.values():
        system.mkdirs(fs.Path(folder))
    for own in below(fs.Path(f"{base}/parts")):  # one file for each profile and year
        profile = own.getName().partition("=")[2]
        for part in below(own) if profile in folders else ():
            year = part.getName().partition("=")[2]
            for file in below(part):
                if file.getName().startswith("part-"):
                    system.rename(file, fs.Path(f"{folders[profile]}/Streaming_History_Audio_{year}.json"))
    return folders, f"{base}/raw"


@query("a2_load_export_records", f"""WITH {o.HIST}, e AS (SELECT *, regexp_extract(source_file, '[0-9]+') || '_' || raw_id % 8 AS part_name FROM hist WHERE source_system = 'export'),
 n AS (SELECT profile_slug, count(*) AS added_first FROM e GROUP BY 1)
 SELECT profile_slug, 'Streaming_History_Audio_' || part_name || '.json' AS source_file, count(*) AS records, CAST(count(*) - 1 AS BIGINT) AS last_index, CAST(sum(ms) AS BIGINT) AS ms, 0 AS with_personal_keys,
  any_value(added_first) AS added_first, 0 AS added_again FROM e JOIN n USING (profile_slug) GROUP BY 1, 2""")
def a2_load(spark, d):
    """Landing files of every profile -> records, twice; the second run finds every record stored."""
    folders, target = _export_folders(spark, d)
    added = []
    for profile, files in folders.items():
        added.append((profile, *[rd.load_export_records(spark, files, profile, target) for _ in range(2)]))
    stored = spark.read.parquet(target)
    keys = F.coalesce(F.json_object_keys("payload"), F.array().cast("array<string>"))
    told = small_table(spark, added, f"{P} string, added_first bigint, added_again int")
    return stored.groupBy(P, "source_file").agg(
        F.count(F.lit(1)).alias("records"), F.max("record_index").alias("last_index"),
        F.sum(F.get_json_object("payload", "$.ms_played").cast("bigint")).alias("ms"),
        F.count_if(F.arrays_overlap(keys, F.array(F.lit("ip_addr"), F.lit("user_agent")))).cast("int").alias("with_personal_keys"),
    ).join(told, P)


_NAMES = """fn AS (SELECT DISTINCT CASE l_linenumber WHEN 1 THEN 'StreamingHistory_music_' || year(l_shipdate) WHEN 2 THEN 'notes_' || year(l_shipdate)
  ELSE 'Streaming_History_Audio_' || year(l_shipdate) || '_' || (l_linenumber % 3) END || '.json' AS name, l_linenumber AS folder FROM lineitem)"""


def _file_names(spark, d):
    line, year = F.col("l_linenumber"), w.text(F.year("l_shipdate"))
    name = (
        F.when(line == 1, F.concat(F.lit("StreamingHistory_music_"), year))
        .when(line == 2, F.concat(F.lit("notes_"), year))
        .otherwise(F.concat(F.lit("Streaming_History_Audio_"), year, F.lit("_"), w.text(line % 3)))
    )
    return table(spark, d, "lineitem").select(
        F.concat(name, F.lit(".json")).alias("name"), line.alias("folder")
    ).distinct()


@query("a3_extended_files", f"WITH {_NAMES} SELECT name, folder FROM fn WHERE folder > 2")
def a3(spark, d):
    return rd.extended_files(_file_names(spark, d))


@query("a3_repeated_names", f"WITH {_NAMES} SELECT name, count(*) AS files FROM fn WHERE folder > 2 GROUP BY 1 HAVING count(*) > 1")
def a3_twice(spark, d):
    return rd.repeated_names(_file_names(spark, d))


@query("a5_registry_errors", """WITH g AS (SELECT CASE WHEN c_acctbal < 0 THEN c_name ELSE lower(replace(c_name, '#', '_')) END AS profile_slug, CASE c_mktsegment WHEN 'BUILDING' THEN 'boss' ELSE 'self' END AS role, CASE WHEN c_nationkey < 3 THEN 'Mars/Base' ELSE 'Europe/Berlin' END AS tz FROM customer),
 h AS (SELECT * FROM g UNION ALL SELECT * FROM g WHERE tz = 'Mars/Base')
 SELECT profile_slug, 'profile_slug' AS rule FROM h WHERE NOT regexp_full_match(profile_slug, '[a-z][a-z0-9_]{0,31}') UNION ALL SELECT profile_slug, 'household_role' FROM h WHERE role = 'boss'
 UNION ALL SELECT profile_slug, 'home_timezone' FROM h WHERE tz = 'Mars/Base' UNION ALL SELECT profile_slug, 'duplicate profile_slug' FROM h GROUP BY 1 HAVING count(*) > 1""")
def a5(spark, d):
    c = table(spark, d, "customer").select(
        F.when(F.col("c_acctbal") < 0, F.col("c_name"))
        .otherwise(F.lower(F.replace("c_name", F.lit("#"), F.lit("_")))).alias(P),
        F.when(F.col("c_mktsegment") == "BUILDING", "boss").otherwise("self").alias("household_role"),
        F.when(F.col("c_nationkey") < 3, "Mars/Base").otherwise("Europe/Berlin").alias("home_timezone"),
    )
    return rd.registry_errors(c.unionByName(c.filter("home_timezone = 'Mars/Base'")))


@query("a6_append_responses", """SELECT 'isrc' AS feed, count(*) AS rows FROM part WHERE p_partkey % 17 <> 0 UNION ALL
 SELECT 'artist', count(*) FROM (SELECT DISTINCT substr(p_brand, 7) AS bn, look FROM part, (VALUES (0), (1), (2), (3)) l(look) WHERE p_size <= 6 AND CAST(substr(p_brand, 7) AS INT) % 5 <> 0 AND p_partkey % 3 <= look)""")
def a6(spark, d):
    path = f"{shared_dir(spark)}/external-{uuid.uuid4().hex}"
    wr.append_responses(w.raw_external(spark, d), path, wr.external_rules(), ("source", "feed"))
    return spark.read.parquet(path).groupBy("feed").agg(F.count(F.lit(1)).alias("rows"))


@query("a6_append_observed", """SELECT 'good' AS batch, 'published' AS outcome, count(*) FILTER (o_orderstatus = 'O') AS rows, 0 AS odd_status, 0 AS lost_response FROM orders
 UNION ALL SELECT 'bad', 'refused', 0, count(*) FILTER (o_orderstatus = 'P'), count(*) FILTER (o_orderstatus = 'F' OR o_orderkey % 11 = 0) FROM orders""")
def a6_observed(spark, d):
    """Two batches, one of which breaks two rules; each is counted and written in one pass."""
    path = f"{shared_dir(spark)}/observed-{uuid.uuid4().hex}"
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.lit("orders").alias("feed"), F.col("o_orderstatus").alias("status"),
        F.when((F.col("o_orderstatus") != "F") & (F.col("o_orderkey") % 11 != 0), F.col("o_orderkey")).alias("raw_id"),
    )
    rules = {"odd_status": F.col("status").isin("O", "F"), "lost_response": F.col("raw_id").isNotNull()}
    wr.append_observed(orders.filter("status = 'O'"), path, {"odd_status": rules["odd_status"]}, "good")
    lost: dict[str, int] = {}
    try:
        wr.append_observed(orders, path, rules, "bad")
    except wr.BatchRefused as refused:
        lost = refused.broken
    shown = spark.read.parquet(path).groupBy("batch").agg(F.count(F.lit(1)).alias("rows"))
    batches = small_table(
        spark,
        [("good", "published", 0, 0), ("bad", "refused" if lost else "published", *(lost.get(x, 0) for x in rules))],
        "batch string, outcome string, odd_status bigint, lost_response bigint",
    )
    return batches.join(shown, "batch", "left").select(
        "batch", "outcome", F.coalesce("rows", F.lit(0)).alias("rows"), "odd_status", "lost_response"
    )


@query("a8_write_sheet", "SELECT row_number() OVER (ORDER BY p_partkey) AS order_number, p_name AS song FROM part")
def a8(spark, d):
    sheet = ranked(
        table(spark, d, "part").select("p_partkey", "p_name"), [F.asc("p_partkey")], "order_number"
    ).select("order_number", F.col("p_name").alias("song"))
    folder = f"{shared_dir(spark)}/sheets-{uuid.uuid4().hex}"
    path = wr.write_sheet(sheet, folder, "Rock & Roll / 1")
    return spark.read.schema("order_number bigint, song string").csv(path, header=True)
