"""The star as stored tables: bucketed by content, refreshed by month, read by reports.

Plays meet content and bridges on the content key. Stored in the same number of buckets of that key,
they join without moving the plays. What reports sum is stored as a cube, one row per (month, profile,
day, content): a content with a third of all plays has as many rows as profiles and days, so no bucket
grows with its plays. A refresh rewrites the months it is given and no others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUBE_KEYS = ("month_key", "profile_key", "date_key", "content_key")


def play_cube(fact: DataFrame) -> DataFrame:
    """Plays summed per month, profile, day and content. A sum of no known time stays NULL."""
    return fact.withColumn("month_key", F.floor(F.col("date_key") / 100).cast("int")).groupBy(*CUBE_KEYS).agg(
        F.count(F.lit(1)).alias("play_count"), F.count("ms_played").alias("rows_with_duration"),
        F.sum("ms_played").alias("ms_played"), F.count_if("is_qualified_play").alias("qualified_play_count"),
    )


@dataclass(frozen=True)
class StoredStar:
    """Tables `<prefix>_<name>` over files below `folder`, which every executor can reach."""

    spark: SparkSession
    folder: str
    prefix: str
    buckets: int = 200

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.prefix}_{name}")

    def _write(self, df: DataFrame, name: str, key: str | None, by: str | None = None) -> None:
        # placed by bucket (and partition) first: a task then writes few files
        placed = df if key is None else df.repartition(self.buckets, key)
        writer = placed.write.format("parquet").mode("overwrite").option("path", f"{self.folder}/{name}")
        if by:
            writer = writer.partitionBy(by)
        if key:
            writer = writer.bucketBy(self.buckets, key).sortBy(key)
        writer.saveAsTable(f"{self.prefix}_{name}")

    def store(self, fact: DataFrame, content: DataFrame, credits: DataFrame, **others: DataFrame) -> None:
        """The cube of `fact` by month, content and its bridge by content key; `others` as they are."""
        self._write(play_cube(fact), "play_cube", "content_key", "month_key")
        self._write(content, "dim_content", "content_key")
        self._write(credits, "br_content_artist", "content_key")
        for name, df in others.items():
            self._write(df, name, None)

    def refresh_months(self, fact: DataFrame) -> None:
        """Replace the months that `fact` has plays of; it must hold all plays of these months."""
        cube = play_cube(fact)
        stored = self.table("play_cube")
        before = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            cube.select(*stored.columns).repartition(self.buckets, "content_key").write.insertInto(
                f"{self.prefix}_play_cube", overwrite=True)
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)

    def primary_plays(self) -> DataFrame:
        """The cube's rows of tracks under their primary artist; joined bucket by bucket."""
        tracks = self.table("dim_content").filter("content_type = 'track'").select("content_key")
        lead = self.table("br_content_artist").filter("is_primary").select("content_key", "artist_key")
        return self.table("play_cube").join(lead, "content_key").join(tracks, "content_key", "left_semi")


def genre_months(star: StoredStar, tag_type: str) -> DataFrame:
    """Plays and time per profile, month and genre bucket, allocated by the artists' genre weights.

    Plays are summed per artist before genres multiply them. Needs br_artist_genre and genre_bucket_map
    among the stored tables.
    """
    sums = star.primary_plays().groupBy("profile_key", "month_key", "artist_key").agg(
        F.sum("play_count").alias("plays"), F.sum("ms_played").alias("ms"))
    genres = star.table("br_artist_genre").filter(F.col("tag_type") == tag_type).select("artist_key", "genre_key", "weight_factor")
    named = star.table("genre_bucket_map").select("genre_key", "bucket_name")
    weight = F.col("weight_factor")
    return sums.join(genres, "artist_key").join(named, "genre_key").groupBy("profile_key", "month_key", "bucket_name").agg(
        F.sum("plays").alias("play_rows"), F.sum(F.col("plays") * weight).alias("allocated_plays"),
        F.sum(F.col("ms") * weight).alias("allocated_ms"))
