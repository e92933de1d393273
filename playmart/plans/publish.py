"""Extracts meant to leave the warehouse, and the manifest that says what they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.config import MS_PER_HOUR, UNCLASSIFIED, UNIDENTIFIED, ExtractOptions
from playmart.functions.text import platform_family
from playmart.operators.sets import with_share
from playmart.plans.timeseries import PROFILE
from playmart.session import small_table
from playmart.sources.writers import write_extract

# Where a published column comes from, and what its reader must know.
SOURCES = {
    "profile_slug": "dim_profile", "play_date": "dim_date by fct_play_event.date_key",
    "month_start": "dim_date by fct_play_event.date_key", "year": "dim_date by fct_play_event.date_key",
    "content_type": "dim_content", "bucket_name": "genre bucket map", "artist_name": "dim_artist",
    "is_identified": "br_content_artist", "plays": "fct_play_event", "qualified_plays": "fct_play_event",
    "ms_played": "fct_play_event", "hours": "fct_play_event", "rows_with_duration": "fct_play_event",
    "allocated_plays": "fct_play_event by br_artist_genre", "allocated_ms": "fct_play_event by br_artist_genre",
    "share_of_music_ms": "allocated time", "step_number": "allocation steps", "step_name": "allocation steps",
    "play_count": "allocation steps", "platform_family": "fct_play_event.platform",
    "conn_country": "fct_play_event",
}
NOTES = {
    "ms_played": "captured plays have no duration; it is never imputed",
    "hours": "of rows with a duration",
    "rows_with_duration": "rows behind ms_played",
    "allocated_plays": "a play is split over its artist's buckets; add these up, not plays",
    "allocated_ms": "a play is split over its artist's buckets; add these up, not ms_played",
    "share_of_music_ms": "within profile and month",
    "artist_name": "(unidentified) where no artist is known",
    "bucket_name": "unclassified where the artist has no genre",
    "play_date": "in the profile's own time zone",
    "month_start": "in the profile's own time zone",
    "platform_family": "the family only, never the device",
    "conn_country": "off unless asked for",
}
DERIVED = "computed for the extract"

EXCLUDED = (
    ("platform (raw)", "fct_play_event", "names a device model; only its family may be published"),
    ("incognito plays", "export records", "marked private by the listener"),
    ("conn_country", "fct_play_event", "a coarse location trace; off unless asked for"),
    ("artist_id / content_uri", "dimensions", "identifiers; a workbook needs names"),
    ("profile_slug (other people)", "dim_profile", "one profile per run"),
    ("display_name / user_id / email", "dim_profile", "personal"),
)


def published_plays(
    fact: DataFrame, profiles: DataFrame, content: DataFrame, credits: DataFrame,
    dates: DataFrame, incognito: DataFrame, opts: ExtractOptions,
) -> DataFrame:
    """The plays an extract may count, with content type, day and primary artist.

    The fact carries no incognito flag, so marked records are taken out by (profile, uri, moment). Content
    and its primary artist meet first, so plays are shuffled once for both.
    """
    who = profiles.filter("profile_key > 0").select("profile_key", PROFILE)
    if opts.profile is not None:
        who = who.filter(F.col(PROFILE) == opts.profile)
    primary = credits.filter("is_primary").select("content_key", "artist_key")
    described = content.select("content_key", "content_uri", "content_type").join(primary, "content_key", "left")
    rows = (
        fact.join(who, "profile_key")
        .join(F.broadcast(dates.select("date_key", "full_date", "year", "month_start")), "date_key")
        .join(described, "content_key")
    )
    if opts.exclude_incognito:
        private = incognito.filter("was_incognito").select(PROFILE, "content_uri", "ended_at_utc")
        rows = rows.join(private, [PROFILE, "content_uri", "ended_at_utc"], "left_anti")
    return rows


_SUMS = ("n", "q", "ms", "timed")


def play_sums(plays: DataFrame, *keys: str | Column) -> DataFrame:
    """Plays, qualified ones, time and plays with a time per key, from plays or from sums of them."""
    if set(_SUMS) <= set(plays.columns):
        return plays.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS])
    return plays.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_qualified_play").alias("q"),
        F.sum("ms_played").alias("ms"), F.count("ms_played").alias("timed"),
    )


def published_sums(plays: DataFrame) -> DataFrame:
    """Published plays per day, content type and artist: what every extract without country or device reads.

    Days, types and artists are few beside plays, so several extracts can share one pass over them.
    """
    return play_sums(plays, PROFILE, "full_date", "year", "content_type", "artist_key")


def artist_bucket_weights(artist_genres: DataFrame, bucket_map: DataFrame, tag_type: str) -> DataFrame:
    """Weight of each bucket per artist: one row per (artist, bucket), weights adding up to one."""
    return (
        artist_genres.filter(F.col("tag_type") == tag_type)
        .join(bucket_map.select("genre_key", "bucket_name"), "genre_key")
        .groupBy("artist_key", "bucket_name").agg(F.sum("weight_factor").alias("weight"))
    )


def _optional(opts: ExtractOptions) -> list[tuple[str, Column]]:
    extra = []
    if opts.include_conn_country:
        extra.append(("conn_country", F.col("conn_country")))
    if opts.include_platform_family:
        extra.append(("platform_family", platform_family(F.col("platform"))))
    return extra


def plays_daily(
    plays: DataFrame, artist_genres: DataFrame, bucket_map: DataFrame, opts: ExtractOptions
) -> DataFrame:
    """Day x content type x bucket (and country or device family when asked for).

    A play counts once in every bucket its artist touches, so `plays` does not add up over buckets;
    the allocated measures do. Weights hang on the artist, so plays are summed per artist first and
    only those sums meet the buckets. A play without a genre is `unclassified`, whole.
    """
    extra = _optional(opts)
    keys = [PROFILE, "play_date", "content_type", *[name for name, _ in extra]]
    sums = play_sums(
        plays.withColumn("play_date", F.col("full_date")).withColumns(dict(extra)), *keys, "artist_key"
    )
    weights = artist_bucket_weights(artist_genres, bucket_map, opts.tag_type)
    shared = sums.join(weights, "artist_key", "left").withColumns(
        {
            "bucket_name": F.coalesce("bucket_name", F.lit(UNCLASSIFIED)),
            "weight": F.coalesce("weight", F.lit(1.0)),
        }
    )
    return shared.groupBy(*keys, "bucket_name").agg(
        F.sum("n").alias("plays"), F.sum("q").alias("qualified_plays"),
        F.sum("ms").alias("ms_played"), F.sum("timed").alias("rows_with_duration"),
        F.sum(F.col("n") * F.col("weight")).alias("allocated_plays"),
        F.sum(F.col("ms") * F.col("weight")).alias("allocated_ms"),
    )


def artists(plays: DataFrame, dim_artist: DataFrame) -> DataFrame:
    """Year x artist over music; plays of nobody known are a row of their own."""
    sums = play_sums(plays.filter("content_type = 'track'"), PROFILE, "year", "artist_key")
    named = sums.join(dim_artist.select("artist_key", "artist_name"), "artist_key", "left")
    return named.groupBy(
        PROFILE, "year", F.coalesce("artist_name", F.lit(UNIDENTIFIED)).alias("artist_name"),
        (F.col("artist_key").isNotNull() & F.col("artist_name").isNotNull()).alias("is_identified"),
    ).agg(
        F.sum("n").alias("plays"), F.sum("q").alias("qualified_plays"),
        F.round(F.sum("ms") / MS_PER_HOUR, 3).alias("hours"),
        F.sum("timed").alias("rows_with_duration"),
    )


def genres(daily: DataFrame) -> DataFrame:
    """Month x bucket over music with its share of the month; NULL time stays NULL."""
    music = daily.filter("content_type = 'track'").groupBy(
        PROFILE, F.trunc("play_date", "month").alias("month_start"), "bucket_name"
    ).agg(
        F.sum("allocated_plays").alias("allocated_plays"),
        F.sum("allocated_ms").alias("allocated_ms"),
    )
    shared = with_share(music, "allocated_ms", [PROFILE, "month_start"], "share_of_music_ms", 1.0)
    return shared.withColumn("share_of_music_ms", F.round("share_of_music_ms", 6))


def published_steps(
    plays: DataFrame, artist_genres: DataFrame, bucket_map: DataFrame, opts: ExtractOptions
) -> DataFrame:
    """The four steps measured over the published plays themselves, from one grouping."""
    reached = artist_bucket_weights(artist_genres, bucket_map, opts.tag_type).select(
        "artist_key"
    ).distinct().withColumn("reached", F.lit(True))
    music, known = F.col("content_type") == "track", F.col("artist_key").isNotNull()
    sums = play_sums(plays, PROFILE, "content_type", "artist_key").join(reached, "artist_key", "left")
    depth = (
        F.when(music & F.col("reached").isNotNull(), 4).when(music & known, 3).when(music, 2)
        .otherwise(1)
    )
    steps = sums.withColumn("step_number", F.explode(F.sequence(F.lit(1), depth)))
    return steps.groupBy(PROFILE, "step_number").agg(
        F.sum("n").alias("published_play_count"), F.sum("ms").alias("published_ms_played"),
        F.sum("timed").alias("published_rows_with_duration"),
    )


def coverage(reconciliation: DataFrame, published: DataFrame) -> DataFrame:
    """The warehouse's steps as they are, with the published ones beside them."""
    return reconciliation.join(published, [PROFILE, "step_number"], "left")


def _span(df: DataFrame) -> Column:
    for name in ("play_date", "month_start"):
        if name in df.columns:
            return F.struct(F.min(name).alias("first"), F.max(name).alias("last"))
    if "year" in df.columns:
        return F.struct(
            F.make_date(F.min("year"), F.lit(1), F.lit(1)).alias("first"),
            F.make_date(F.max("year"), F.lit(12), F.lit(31)).alias("last"),
        )
    none = F.lit(None).cast("date")
    return F.struct(none.alias("first"), none.alias("last"))


def extract_summary(extracts: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and date span of every extract."""
    out = None
    for name, df in extracts.items():
        one = df.agg(F.count(F.lit(1)).alias("rows"), _span(df).alias("s")).select(
            F.lit(name).alias("extract"), "rows", F.lit(len(df.columns)).alias("columns"),
            F.col("s.first").alias("first_date"), F.col("s.last").alias("last_date"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def write_extracts(extracts: dict[str, DataFrame], folder: str) -> DataFrame:
    """Write every extract below the folder, and summarise what was written from the files."""
    written = {}
    for name, df in extracts.items():
        path = f"{folder}/{name}"
        write_extract(df, path)
        written[name] = df.sparkSession.read.schema(df.schema).csv(path, header=True)
    return extract_summary(written)


def manifest(spark: SparkSession, extracts: dict[str, DataFrame]) -> DataFrame:
    """Every column of every extract with its source, and every field left out with the reason."""
    rows = [
        (f"{name}.csv", c, "yes", SOURCES.get(c, DERIVED), NOTES.get(c, ""))
        for name, df in extracts.items() for c in df.columns
    ]
    rows += [("(all)", name, "NO", source, why) for name, source, why in EXCLUDED]
    return small_table(
        spark, rows, "file string, column string, included string, source string, note string"
    )


def written_manifest(extracts: dict[str, DataFrame], folder: str) -> DataFrame:
    """The manifest of extracts written below `folder`, with the rows of each file and the filled ones of
    each column, counted in the files in one pass each. Fields left out have no counts."""
    counts = None
    for name, df in extracts.items():
        path = f"{folder}/{name}"
        write_extract(df, path)
        back = df.sparkSession.read.schema(df.schema).csv(path, header=True)
        told = F.array(*[F.struct(F.lit(f"{name}.csv").alias("file"), F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"),
                                  F.count(F.col(c)).alias("filled")) for c in back.columns])
        one = back.agg(told.alias("t")).select(F.explode("t").alias("t")).select("t.*")
        counts = one if counts is None else counts.unionByName(one)
    whole = manifest(next(iter(extracts.values())).sparkSession, extracts)
    return whole.join(counts, ["file", "column"], "left")
