"""The given tables read as listening data.

Three views of them: `events` as two overlapping play sources; `lineitem`, `orders` and `part` as a
long listening history with its catalogue; suppliers as playlists. All of it is derived by Spark, so
every query grows with the tables.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.base import table, utc
from playmart.config import GENRE_BUCKETS
from playmart.functions.text import content_match_key
from playmart.operators.ordered import keep_first, split_scan
from playmart.plans import allocation, content, star
from playmart.plans.events import coverage_windows, dedupe_play_events
from playmart.plans.timeseries import enriched_plays
from playmart.session import shuffle_partitions, small_table
from playmart.sources import staging

PROFILES = (
    ("p0", "self", "America/Los_Angeles"),
    ("p1", "spouse", "America/New_York"),
    ("p2", "child", "Europe/Berlin"),
    ("p3", "friend", "Asia/Tokyo"),
    ("p4", "friend", "UTC"),
)
# first word of a genre -> bucket; 'small' is left out so that `other` has something to hold
GENRE_SEED = (
    ("economy", "pop"), ("medium", "rock"), ("standard", "jazz / blues"), ("promo", "classical"),
    ("large", "latin"),
)
EPOCH = "1990-01-01"  # the tables reach back further than the default epoch
_memo: dict[tuple, object] = {}


def _once(spark: SparkSession, d: str, what: str, build):
    """Relations with several consumers are built and kept once per session, as `pipeline` does."""
    key = (spark.sparkContext.applicationId, d, what)
    if key not in _memo:
        _memo[key] = build()
    return _memo[key]


def planned(fn):
    """Keep the (lazy) plan a view of the tables builds; nothing is computed or cached by it."""

    @wraps(fn)
    def view(spark: SparkSession, d: str) -> DataFrame:
        return _once(spark, d, fn.__name__, lambda: fn(spark, d))

    return view


def text(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def registry(spark: SparkSession) -> DataFrame:
    return small_table(
        spark, list(PROFILES), "profile_slug string, household_role string, home_timezone string"
    )


def profiles(spark: SparkSession) -> DataFrame:
    rows = [(n, *row) for n, row in enumerate(PROFILES, start=1)]
    return small_table(
        spark, rows,
        "profile_key int, profile_slug string, household_role string, home_timezone string",
    )


def uri_of(part: Column) -> Column:
    kind = (
        F.when(part % 10 == 0, "episode").when(part % 10 == 1, "chapter").otherwise("track")
    )
    return F.concat(F.lit("media:"), kind, F.lit(":"), part.cast("string"))


def type_of(part: Column) -> Column:
    return (
        F.when(part % 10 == 0, "episode").when(part % 10 == 1, "audiobook_chapter")
        .otherwise("track")
    )


# --- events: two overlapping sources --------------------------------------------------------------


@planned
def event_plays(spark: SparkSession, d: str) -> DataFrame:
    """Views and clicks as captured plays, the rest as exported ones, with three kinds of repeats."""
    e = table(spark, d, "events").select(
        "event_id", "user_id", "event_type", "value", utc("ts").alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    api = F.col("event_type").isin("view", "click")
    none = F.lit(None).cast("int")
    copies = F.array_compact(
        F.array(
            F.lit(0),
            F.when(api & (F.col("event_id") % 7 == 0), F.lit(1)),
            F.when(~api & (F.col("event_id") % 5 == 0), F.lit(2)),
            F.when(~api & (F.col("event_id") % 11 == 0), F.lit(3)),
        )
    )
    rows = e.withColumn("copy", F.explode(copies)).withColumn(
        "source_system",
        F.when(api | (F.col("copy") == 2), "api").otherwise("export"),
    )
    second = F.date_trunc("second", "ts")
    exported = F.col("source_system") == "export"
    ended = F.when(F.col("copy") == 2, second + F.expr("interval 5 second")).when(
        api, F.col("ts")
    ).otherwise(second)
    ms = F.when(exported, F.round(F.col("value") * 1000).cast("bigint"))
    late = F.when(F.col("copy") == 1, F.expr("interval 2 day")).otherwise(F.expr("interval 1 day"))
    flag = lambda c: F.when(exported, c)
    return rows.select(
        F.concat(F.lit("p"), text(F.col("user_id") % 5)).alias("profile_slug"),
        F.concat(F.lit("media:track:t"), text("k")).alias("content_uri"),
        type_of(F.col("k")).alias("content_type"),
        ended.alias("ended_at_utc"),
        ms.alias("ms_played"),
        F.lit(False).alias("is_ms_played_imputed"),
        flag(F.lit("clickrow")).alias("reason_start"),
        flag(F.col("event_type")).alias("reason_end"),
        flag(F.col("event_type") == "error").alias("was_skipped"),
        flag(F.col("user_id") % 2 == 0).alias("was_shuffled"),
        flag(F.col("user_id") % 3 == 0).alias("was_offline"),
        flag(F.lit("android")).alias("platform"),
        flag(F.lit("US")).alias("conn_country"),
        "source_system",
        F.concat(F.lit("f"), text(F.col("user_id") % 5)).alias("source_file"),
        (F.col("ts") + late).alias("ingested_at"),
        (F.col("event_id") + F.col("copy") * 1_000_000_000_000).alias("raw_response_id"),
        F.lit(1).alias("item_ordinal"),
    )


@planned
def event_content(spark: SparkSession, d: str) -> DataFrame:
    """The items the events name, as a content dimension: every second one has a known length."""
    keys = (
        table(spark, d, "events")
        .select(F.get_json_object("props", "$.k").cast("int").alias("k")).distinct()
    )
    return keys.filter("k is not null").select(
        (F.col("k") + 1).alias("content_key"),
        F.concat(F.lit("media:track:t"), text("k")).alias("content_uri"),
        type_of(F.col("k")).alias("content_type"),
        F.when(F.col("k") % 2 == 0, F.col("k") * 1000).alias("duration_ms"),
    )


@planned
def captured_pages(spark: SparkSession, d: str) -> DataFrame:
    """Views and clicks as the JSON pages a poll would have landed.

    A page holds one user's items out of 2,000 consecutive events, so no page can outgrow that.
    """
    e = table(spark, d, "events").filter(F.col("event_type").isin("view", "click")).select(
        "event_id", "user_id", utc("ts").alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    k = F.col("k")
    artist = lambda n: F.struct(
        F.concat(F.lit("a"), text(n)).alias("id"),
        F.concat(F.lit("media:artist:a"), text(n)).alias("uri"),
        F.concat(F.lit("Artist "), text(n)).alias("name"),
    )
    item = F.struct(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("played_at"),
        F.struct(
            F.when(k % 13 != 0, F.concat(F.lit("media:track:t"), text(k))).alias("uri"),
            F.concat(F.lit("t"), text(k)).alias("id"),
            type_of(k).alias("type"),
            F.concat(F.lit("Title "), text(k)).alias("name"),
            (k * 1000).alias("duration_ms"),
            (k % 2 == 0).alias("explicit"),
            F.struct(F.when(k % 4 != 0, F.concat(F.lit("isrc"), text(k))).alias("isrc")).alias(
                "external_ids"
            ),
            F.struct(
                F.concat(F.lit("al"), text(k % 9)).alias("id"),
                F.concat(F.lit("Album "), text(k % 9)).alias("name"),
                F.lit("2001").alias("release_date"),
            ).alias("album"),
            F.when(k % 6 != 0, F.array(artist(k % 20), artist(k % 7))).alias("artists"),
        ).alias("track"),
    )
    pages = e.groupBy("user_id", F.floor(F.col("event_id") / 2000).alias("page")).agg(
        F.array_sort(F.collect_list(item)).alias("items"), F.max("ts").alias("last")
    )
    return pages.select(
        (F.col("page") * 100_000_000 + F.col("user_id")).alias("id"),
        F.lit("recently_played").alias("feed"),
        F.concat(F.lit("p"), text(F.col("user_id") % 5)).alias("profile_slug"),
        F.lit("capture.json").alias("source_file"),
        (F.col("last") + F.expr("interval 1 minute")).alias("ingested_at"),
        F.to_json(F.struct("items")).alias("payload"),
    )


def polls(spark: SparkSession, d: str, size: int = 10, drop_every: int = 4) -> DataFrame:
    """Every user's plays cut into captures of `size`, each fourth capture lost."""
    e = table(spark, d, "events").select("event_id", "user_id", utc("ts").alias("ts"))
    numbered = split_scan(
        e, ["user_id"], ["ts", "event_id"], F.to_date("ts"), row_number="n"
    ).withColumn("batch", F.floor((F.col("n") - 1) / size).cast("bigint"))
    return (
        numbered.groupBy("user_id", "batch")
        .agg(F.min("ts").alias("oldest"), F.max("ts").alias("newest"),
             F.count(F.lit(1)).alias("items_returned"))
        .filter(F.col("batch") % drop_every != drop_every - 1)
        .select(
            F.concat(F.lit("u"), text("user_id")).alias("profile_slug"), "batch", "oldest",
            "newest", "items_returned",
            (F.col("newest") + F.expr("interval 1 minute")).alias("captured_at"),
        )
    )


# --- lineitem, orders, part: a long history -------------------------------------------------------


def parts(spark: SparkSession, d: str) -> DataFrame:
    """Parts dealt out by key: the file is small for its rows, so few tasks would read and describe them all."""
    return table(spark, d, "part").repartition("p_partkey")


@planned
def history(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as plays: a line was shipped when it was heard, and its quantity is how long."""
    return _plays(spark, d)


@planned
def spread_history(spark: SparkSession, d: str) -> DataFrame:
    """The same plays, left in all shuffle partitions by the join.

    Merged by bytes, a partition of these narrow rows holds millions: too many for a reader that widens
    each and sorts them on the map side.
    """
    return _plays(spark, d, spread=True)


def _plays(spark: SparkSession, d: str, spread: bool = False) -> DataFrame:
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag",
        "l_linestatus", utc("l_shipdate").alias("shipped"),
    )
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    # both sides grow with the history, so neither is ever a broadcast side
    if spread:
        li = li.repartition(shuffle_partitions(spark), "l_orderkey")
    rows = li.join(o.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    line, part, supp = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    order, cust = F.col("l_orderkey"), F.col("o_custkey")
    api = line == 7
    late = F.when(F.month("shipped").isin(3, 4), 14400).otherwise(0)
    second = F.pmod(order * 7919 + line * 104729 + part * 31, F.lit(36000)) + 36000 + late
    amount = F.col("l_quantity").cast("bigint")
    ms = (
        F.when(api, F.lit(None)).when(amount % 9 == 0, F.lit(0))
        .when(order % 97 == 0, amount * 600_000).otherwise(amount * 6_000).cast("bigint")
    )
    device = F.element_at(
        F.array(*[F.lit(x) for x in DEVICES]), (supp % len(DEVICES)).cast("int") + 1
    )
    country = (
        F.when(cust % 10 < 6, "US").when(cust % 10 == 6, "CA").when(cust % 10 == 7, "MX")
        .when(cust % 10 == 8, "ZZ")
    )
    started = F.concat_ws(
        "-", F.lower(F.substring("o_orderpriority", 3, 20)), F.col("l_returnflag")
    )
    ended = F.get(
        F.array(*[F.lit(x) for x in REASONS]), ((part + line) % (len(REASONS) + 1)).cast("int")
    )
    epoch = F.unix_timestamp("shipped") + second
    return rows.select(
        F.concat(F.lit("p"), text(cust % 5)).alias("profile_slug"),
        uri_of(part).alias("content_uri"),
        type_of(part).alias("content_type"),
        F.timestamp_seconds(epoch).alias("ended_at_utc"),
        ms.alias("ms_played"),
        F.lit(False).alias("is_ms_played_imputed"),
        F.when(supp % 25 != 0, started).alias("reason_start"),
        ended.alias("reason_end"),
        F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False).alias(
            "was_skipped"
        ),
        (F.col("l_linestatus") == "O").alias("was_shuffled"),
        (supp % 4 == 0).alias("was_offline"),
        (supp % 40 == 0).alias("was_incognito"),
        F.when(device != "", device).alias("platform"),
        country.alias("conn_country"),
        F.when(api, "api").otherwise("export").alias("source_system"),
        F.concat(F.lit("history_"), text(F.year("shipped")), F.lit(".json")).alias("source_file"),
        F.timestamp_seconds(epoch + 86400).alias("ingested_at"),
        (order * 10 + line).alias("raw_response_id"),
        F.when(line == 3, epoch * 1000).when(line < 3, epoch).alias("offline_timestamp_raw"),
        part.alias("part"),
    )


DEVICES = ("Android OS 10", "iOS 12.1", "windows 10", "OSX 10.15", "web_player osx",
           "Partner amazon_echo", "", "Linux")
REASONS = ("trackdone", "fwdbtn", "trackerror", "unknown", "endplay", "logout", "backbtn",
           "clickrow")


@planned
def catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Parts as content, with natural keys: part n is content n + 1."""
    n = F.col("p_partkey")
    known = n % 3 != 0
    return table(spark, d, "part").select(
        (n + 1).alias("content_key"),
        uri_of(n).alias("content_uri"),
        type_of(n).alias("content_type"),
        F.concat_ws(" ", "p_name", text(n % 50)).alias("content_name"),
        F.concat_ws(" ", "p_type", text(F.col("p_size") % 5)).alias("parent_name"),
        F.when(n % 37 != 0, F.col("p_brand")).alias("primary_creator_name"),
        F.when(known, F.col("p_size") * 10_000).alias("duration_ms"),
        known.alias("is_resolved"),
    )


def brand_number() -> Column:
    return F.substring("p_brand", 7, 10).cast("int")


def mbid(number: Column) -> Column:
    h = F.md5(F.concat(F.lit("artist"), number.cast("string")))
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
        F.substring(h, 17, 4), F.substring(h, 21, 12),
    )


def isrc_of(part: Column) -> Column:
    return F.concat(F.lit("USABC"), F.lpad((part % 10_000_000).cast("string"), 7, "0"))


@planned
def raw_tracks(spark: SparkSession, d: str) -> DataFrame:
    """A JSON document per resolved track; every fourth one was looked up again under a new name."""
    n, bn = F.col("p_partkey"), brand_number()
    part = parts(spark, d).filter((n % 3 != 0) & (n % 10 > 1))
    seen = part.withColumn(
        "look", F.explode(F.when(n % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    )
    again = F.col("look") == 1
    artist = lambda i: F.struct(
        F.concat(F.lit("a"), text(i)).alias("id"),
        F.concat(F.lit("media:artist:a"), text(i)).alias("uri"),
        F.concat(F.lit("Artist "), text(i)).alias("name"),
    )
    lead, guest = artist(bn), artist(bn % 25 + 1)
    artists = F.when(n % 15 == 0, F.array(lead, guest, lead)).when(
        n % 5 == 0, F.array(lead, guest)
    ).otherwise(F.array(lead))
    name = F.concat_ws(" ", "p_name", text(n % 50))
    code = F.when(n % 17 != 0, F.when(n % 2 == 0, isrc_of(n)).otherwise(
        F.concat(F.lit("US-ABC-"), F.lpad(text(n % 10_000_000), 7, "0"))
    ))
    doc = F.struct(
        uri_of(n).alias("uri"),
        F.concat(F.lit("t"), text(n)).alias("id"),
        F.lit("track").alias("type"),
        F.when(again, F.concat(name, F.lit(" (Live)"))).otherwise(name).alias("name"),
        (F.col("p_size") * 10_000).alias("duration_ms"),
        (F.col("p_size") % 2 == 0).alias("explicit"),
        F.lit(1).alias("disc_number"),
        F.col("p_size").alias("track_number"),
        F.lit(False).alias("is_local"),
        F.struct(code.alias("isrc")).alias("external_ids"),
        F.struct(
            F.concat(F.lit("al"), text(n % 200)).alias("id"),
            F.concat(F.lit("media:album:al"), text(n % 200)).alias("uri"),
            F.concat(F.lit("Album "), text(n % 200)).alias("name"),
            F.lit("album").alias("album_type"),
            F.concat(text(1990 + n % 30), F.lit("-01")).alias("release_date"),
            F.lit("month").alias("release_date_precision"),
            F.lit(10).alias("total_tracks"),
            F.array(lead).alias("artists"),
        ).alias("album"),
        artists.alias("artists"),
    )
    day0 = F.to_timestamp(F.lit("2002-01-01"))
    at = F.when(again, F.to_timestamp(F.lit("2002-03-01"))).otherwise(
        F.timestamp_seconds(F.unix_timestamp(day0) + (n % 28) * 86400)
    )
    return seen.select(
        (n + F.col("look") * 10_000_000_000).alias("id"), F.lit("track").alias("feed"),
        F.lit("p0").alias("profile_slug"), F.lit("track.json").alias("source_file"),
        at.alias("ingested_at"), F.to_json(doc).alias("payload"),
    )


@planned
def raw_external(spark: SparkSession, d: str) -> DataFrame:
    """Recording-code lookups (one per part) and four observations of every external artist."""
    n, bn = F.col("p_partkey"), brand_number()
    part = parts(spark, d)
    own = F.when(bn % 7 == 0, mbid(bn + (n % 2) * 100)).otherwise(mbid(bn))
    credit = lambda i: F.struct(
        F.array(F.struct(F.struct(i.alias("id")).alias("artist"))).alias("artist-credit")
    )
    second = (
        F.when(n % 41 == 0, mbid(bn + 1)).when(n % 29 == 0, F.lit("not-an-id")).otherwise(own)
    )
    found = F.to_json(F.struct(F.array(credit(own), credit(second)).alias("recordings")))
    lookups = part.filter(n % 17 != 0).select(
        n.alias("id"), F.lit("musicbrainz").alias("source"), F.lit("isrc").alias("feed"),
        isrc_of(n).alias("request_key"), F.to_timestamp(F.lit("2002-06-01")).alias("ingested_at"),
        F.when(n % 13 == 0, F.lit('{"error":"Not Found"}')).otherwise(found).alias("payload"),
    )
    observed = part.filter((F.col("p_size") <= 6) & (bn % 5 != 0)).withColumn(
        "look", F.explode(F.sequence(F.lit(0), F.lit(3)))
    ).filter(n % 3 <= F.col("look"))
    kind = F.when(F.col("p_size") <= 4, "genre").otherwise("tag")
    label = F.when(
        F.col("p_size") <= 4, F.concat_ws(" ", F.lower("p_type"), text(F.col("p_size") % 3))
    ).otherwise(F.concat(F.lit("size "), text("p_size")))
    votes = observed.groupBy(
        bn.alias("bn"), "look", kind.alias("kind"), label.alias("name")
    ).agg(F.count(F.lit(1)).cast("int").alias("count"))
    entry = F.struct("name", "count")
    pick = lambda k: F.array_sort(F.collect_list(F.when(F.col("kind") == k, entry)))
    # at most eighteen genre strings and two tags exist, so a document is small
    docs = votes.groupBy("bn", "look").agg(pick("genre").alias("genres"), pick("tag").alias("tags"))
    doc = F.to_json(
        F.struct(F.concat(F.lit("Artist "), text("bn")).alias("name"), "genres", "tags")
    )
    artists = docs.select(
        (F.col("bn") * 10 + F.col("look")).cast("bigint").alias("id"),
        F.lit("musicbrainz").alias("source"), F.lit("artist").alias("feed"),
        mbid(F.col("bn")).alias("request_key"),
        F.add_months(F.lit("2003-01-15").cast("date"), F.col("look")).cast("timestamp").alias(
            "ingested_at"
        ),
        F.when(
            (F.col("bn") % 11 == 0) & (F.col("look") == 0), F.lit('{"error":"Not Found"}')
        ).otherwise(doc).alias("payload"),
    )
    return lookups.unionByName(artists)


def raw_artists(spark: SparkSession, d: str) -> DataFrame:
    """Own lookups of every third artist, some without the `genres` key."""
    bn = brand_number()
    rows = table(spark, d, "part").select(bn.alias("bn")).distinct().filter("bn % 3 = 0")
    name = F.concat(F.lit("Artist No. "), text("bn"))
    ident = F.concat(F.lit("a"), text("bn"))
    base = F.struct(ident.alias("id"), F.concat(F.lit("media:artist:"), ident).alias("uri"),
                    name.alias("name"))
    full = F.struct(ident.alias("id"), F.concat(F.lit("media:artist:"), ident).alias("uri"),
                    name.alias("name"), F.array().cast("array<string>").alias("genres"))
    return rows.select(
        F.col("bn").cast("bigint").alias("id"), F.lit("artist").alias("feed"),
        F.lit("p0").alias("profile_slug"), F.lit("artist.json").alias("source_file"),
        F.to_timestamp(F.lit("2002-05-01")).alias("ingested_at"),
        F.when(F.col("bn") % 2 == 0, F.to_json(full)).otherwise(F.to_json(base)).alias("payload"),
    )


def stg_no_plays(spark: SparkSession, d: str) -> DataFrame:
    """The recently-played relation of a catalogue nobody polled: right columns, no rows."""
    return staging.recently_played(raw_tracks(spark, d))


def tracks(spark: SparkSession, d: str) -> DataFrame:
    return _once(spark, d, "tracks", lambda: content.tracks_latest(
        stg_no_plays(spark, d), staging.track(raw_tracks(spark, d))
    ).persist())


@planned
def credits(spark: SparkSession, d: str) -> DataFrame:
    return content.content_artists(tracks(spark, d))


@planned
def isrc_artists(spark: SparkSession, d: str) -> DataFrame:
    return content.isrc_artist(staging.isrc_lookup(raw_external(spark, d)))


@planned
def external_artists(spark: SparkSession, d: str) -> DataFrame:
    return staging.external_artist(raw_external(spark, d))


def artist_map(spark: SparkSession, d: str) -> DataFrame:
    return _once(spark, d, "artist_map", lambda: content.artist_external_map(
        credits(spark, d), tracks(spark, d), isrc_artists(spark, d)
    ).persist())


def tags(spark: SparkSession, d: str) -> DataFrame:
    return _once(spark, d, "tags", lambda: content.artist_tags(
        external_artists(spark, d)
    ).persist())


@planned
def artists(spark: SparkSession, d: str) -> DataFrame:
    return content.artists_latest(
        stg_no_plays(spark, d), staging.track(raw_tracks(spark, d)),
        staging.artist(raw_artists(spark, d)),
    )


@planned
def current_genres(spark: SparkSession, d: str) -> DataFrame:
    return content.artist_genres_current(
        artist_map(spark, d), external_artists(spark, d), tags(spark, d)
    )


def dim_artist(spark: SparkSession, d: str) -> DataFrame:
    return _once(spark, d, "dim_artist", lambda: star.dim_artist(
        artists(spark, d), artist_map(spark, d), external_artists(spark, d), tags(spark, d),
        EPOCH,
    ).persist())


def dim_genre(spark: SparkSession, d: str) -> DataFrame:
    return _once(spark, d, "dim_genre", lambda: star.dim_genre(tags(spark, d)).persist())


def br_artist_genre(spark: SparkSession, d: str) -> DataFrame:
    return _once(spark, d, "br_artist_genre", lambda: star.br_artist_genre(
        dim_artist(spark, d), tags(spark, d), dim_genre(spark, d)
    ).persist())


@planned
def br_content_artist(spark: SparkSession, d: str) -> DataFrame:
    return star.br_content_artist(credits(spark, d), catalogue(spark, d), dim_artist(spark, d))


def primary_artists(spark: SparkSession, d: str) -> DataFrame:
    return credits(spark, d).filter("is_primary").select("content_uri", "artist_id")


def buckets(spark: SparkSession) -> DataFrame:
    rows = [(n, name, n) for n, name in enumerate(GENRE_BUCKETS, start=1)]
    return small_table(spark, rows, "genre_bucket_key int, bucket_name string, bucket_order int")


def genre_seed(spark: SparkSession) -> DataFrame:
    rows = [(f"{word} {n}", bucket) for word, bucket in GENRE_SEED for n in range(3)]
    return small_table(spark, rows, "genre_name string, bucket_name string")


@planned
def bucket_map(spark: SparkSession, d: str) -> DataFrame:
    return allocation.genre_bucket_map(dim_genre(spark, d), genre_seed(spark), buckets(spark))


# --- the star over the history --------------------------------------------------------------------


def dim_date(spark: SparkSession) -> DataFrame:
    return _once(spark, "", "dim_date", lambda: star.dim_date(spark, "2026-12-31", EPOCH))


@planned
def fact(spark: SparkSession, d: str) -> DataFrame:
    return star.fct_play_event(history(spark, d), profiles(spark), catalogue(spark, d))


@planned
def plays(spark: SparkSession, d: str) -> DataFrame:
    return enriched_plays(
        fact(spark, d), profiles(spark), dim_date(spark), star.dim_time_of_day(spark),
        catalogue(spark, d),
        catalogue(spark, d).filter("is_resolved and content_type = 'track'").select(
            "content_key", F.lit(True).alias("is_primary")
        ),
    )


def windows(spark: SparkSession, d: str) -> DataFrame:
    """One row per profile, read from the history once per session."""
    return _once(spark, d, "windows", lambda: coverage_windows(
        history(spark, d), profiles(spark)
    ).persist())


@planned
def bucket_allocation(spark: SparkSession, d: str) -> DataFrame:
    return allocation.genre_bucket_allocation(
        fact(spark, d), profiles(spark), dim_date(spark), catalogue(spark, d),
        br_content_artist(spark, d), br_artist_genre(spark, d), bucket_map(spark, d),
        dim_artist(spark, d),
    )


@planned
def event_fact(spark: SparkSession, d: str) -> DataFrame:
    return star.fct_play_event(
        dedupe_play_events(event_plays(spark, d)), profiles(spark), event_content(spark, d)
    )


# --- suppliers as playlists -----------------------------------------------------------------------


@planned
def playlist_items(spark: SparkSession, d: str) -> DataFrame:
    """Every line is an entry of its supplier's playlist in the year it shipped."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", utc("l_shipdate").alias("at")
    )
    n = F.col("l_partkey")
    return li.select(
        F.make_date(F.year("at"), F.lit(12), F.lit(31)).alias("snapshot_date"),
        F.concat(F.lit("pl"), text("l_suppkey")).alias("playlist_id"),
        uri_of(n).alias("content_uri"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"),
        F.lit(1).alias("raw_response_id"),
        F.when(n % 17 != 0, F.concat(F.lit("I"), text(n % 1500))).alias("isrc"),
        F.col("at").alias("added_at"), n.alias("part"),
    )


@planned
def membership(spark: SparkSession, d: str) -> DataFrame:
    """One row per (snapshot, playlist, uri) with the three keys a comparison can match on."""
    first = keep_first(
        playlist_items(spark, d), ["snapshot_date", "playlist_id", "content_uri"],
        [F.asc("position"), F.asc("added_at")],
    )
    names = table(spark, d, "part").select(
        F.col("p_partkey").alias("part"),
        F.concat_ws(" ", "p_name", text(F.col("p_partkey") % 50)).alias("title"),
        F.col("p_brand").alias("artist"),
        F.concat_ws(" ", "p_type", text(F.col("p_size") % 5)).alias("album"),
    )
    named = first.join(names, "part")
    return named.withColumn(
        "content_match_key", content_match_key(F.col("title"), F.col("artist"))
    )


@planned
def raw_playlists(spark: SparkSession, d: str) -> DataFrame:
    """A page per playlist and quarter; the size it reports moves in steps of fifty lines."""
    li = table(spark, d, "lineitem").select("l_suppkey", utc("l_shipdate").alias("at"))
    per = li.groupBy("l_suppkey", F.date_trunc("quarter", "at").alias("quarter")).agg(
        F.count(F.lit(1)).alias("n")
    )
    s = F.col("l_suppkey")
    total = F.struct(F.floor(F.col("n") / 10).alias("total"))
    row = F.struct(
        F.concat(F.lit("pl"), text(s)).alias("id"),
        F.concat(F.lit("media:playlist:pl"), text(s)).alias("uri"),
        F.concat(F.lit("Playlist "), text(s)).alias("name"),
        F.when(s % 3 == 0, "").otherwise("mixed").alias("description"),
        (s % 2 == 0).alias("is_owned_by_profile"),
        F.lit(False).alias("collaborative"),
        (s % 5 == 0).alias("public"),
        text(F.year("quarter")).alias("snapshot_id"),
        F.when(s % 2 == 0, total).alias("items"),
        F.when(s % 2 == 1, total).alias("tracks"),
    )
    return per.select(
        s.alias("id"), F.lit("playlist").alias("feed"), F.lit("p0").alias("profile_slug"),
        F.lit("playlist.json").alias("source_file"), F.col("quarter").alias("ingested_at"),
        F.to_json(F.struct(F.array(row).alias("items"))).alias("payload"),
    )
