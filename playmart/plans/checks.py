"""Data-quality checks. Each returns the rows that break a rule; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.config import EXPORT_PII_KEYS, OTHER_BUCKET, SETTINGS
from playmart.operators.sets import pair_overlaps
from playmart.sources.writers import fingerprint


def not_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def nulls_in(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unexpected_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    return df.filter(~F.col(column).isin(*accepted)).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys the parent does not hold, with how many rows use each."""
    used = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(key)).agg(
        F.count(F.lit(1)).alias("n")
    )
    return used.join(parent.select(key), key, "left_anti")


def star_orphans(links: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """All foreign keys of the star: (link, key, rows). `links`: name, child, column, parent, key."""
    out = None
    for name, child, column, parent, key in links:
        part = orphans(child, column, parent, key).select(
            F.lit(name).alias("link"), F.col(key).cast("string").alias("key"), "n"
        )
        out = part if out is None else out.unionByName(part)
    return out


def fact_grain(plays: DataFrame) -> DataFrame:
    """Two plays of the same profile, content and second."""
    second = F.date_trunc("second", "ended_at_utc")
    return not_unique(
        plays.withColumn("second", second), ["profile_key", "content_key", "second"]
    )


def dedupe_rules(plays: DataFrame) -> DataFrame:
    """The three rules of the dedupe, each on its own key, in one grouping.

    Every play is put under its minute; a minute holding two API rows, or API and export rows
    together, breaks a rule, and so does an exact moment two export rows share.
    """
    is_api = F.col("source_system") == "api"
    on = ["profile_slug", "content_uri"]
    minutes = plays.groupBy(*on, F.date_trunc("minute", "ended_at_utc").alias("at")).agg(
        F.count_if(is_api).alias("api"), F.count_if(~is_api).alias("export")
    )
    twice = minutes.filter("api > 1").select(*on, "at", F.lit("api/api minute").alias("rule"))
    both = minutes.filter("api > 0 and export > 0").select(
        *on, "at", F.lit("export/api minute").alias("rule")
    )
    exact = plays.filter(~is_api).groupBy(*on, F.col("ended_at_utc").alias("at")).agg(
        F.count(F.lit(1)).alias("n")
    ).filter("n > 1").select(*on, "at", F.lit("export/export second").alias("rule"))
    return twice.unionByName(both).unionByName(exact)


def chain_breaks(steps: DataFrame) -> DataFrame:
    """Steps that, with their residual, do not equal the step before them."""
    cols = ["profile_slug", "step_number", "play_count", "ms_played"]
    before = steps.select(
        "profile_slug", (F.col("step_number") + 1).alias("step_number"),
        F.col("play_count").alias("previous_count"),
        F.coalesce("ms_played", F.lit(0)).alias("previous_ms"),
    )
    pairs = steps.select(*cols, "residual_play_count", "residual_ms_played").join(
        before, ["profile_slug", "step_number"]
    )
    count = F.col("play_count") + F.col("residual_play_count")
    ms = F.coalesce("ms_played", F.lit(0)) + F.coalesce("residual_ms_played", F.lit(0))
    return pairs.filter((count != F.col("previous_count")) | (ms != F.col("previous_ms")))


def first_step_mismatch(steps: DataFrame, fact: DataFrame, profiles: DataFrame) -> DataFrame:
    counted = fact.groupBy("profile_key").agg(F.count(F.lit(1)).alias("fact_plays")).join(
        profiles.select("profile_key", "profile_slug"), "profile_key"
    ).drop("profile_key")
    first = steps.filter("step_number = 1").select("profile_slug", "play_count")
    both = first.join(counted, "profile_slug", "full_outer")
    return both.filter(~F.col("play_count").eqNullSafe(F.col("fact_plays")))


def allocation_mismatch(steps: DataFrame, allocation: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Profiles whose bucket time is not the last step's time."""
    given = allocation.groupBy("profile_slug").agg(F.sum("allocated_ms").alias("allocated_ms"))
    last = steps.filter("step_number = 4").select("profile_slug", "ms_played")
    both = last.join(given, "profile_slug", "full_outer")
    gap = F.abs(F.coalesce("ms_played", F.lit(0)) - F.coalesce("allocated_ms", F.lit(0.0)))
    return both.withColumn("gap", gap).filter(F.col("gap") > tolerance)


def other_share(allocation: DataFrame, limit: float = SETTINGS.other_share_limit) -> DataFrame:
    """The share of `other`, when it is above the limit."""
    is_other = F.col("bucket_name") == OTHER_BUCKET
    sums = allocation.agg(
        F.sum(F.when(is_other, F.col("allocated_ms"))).alias("other_ms"),
        F.sum("allocated_ms").alias("total_ms"),
    )
    return sums.withColumn("share", F.col("other_ms") / F.col("total_ms")).filter(
        F.col("share") > limit
    )


def weights_off(bridge: DataFrame, keys: Sequence[str] = ("artist_key", "tag_type")) -> DataFrame:
    return bridge.groupBy(*keys).agg(F.sum("weight_factor").alias("total")).filter(
        F.abs(F.col("total") - 1) > 1e-6
    )


def not_one_current(versions: DataFrame, key: str) -> DataFrame:
    return versions.groupBy(key).agg(F.count_if("is_current").alias("current_versions")).filter(
        "current_versions <> 1"
    )


def access_mismatch(profiles: DataFrame, tokens: DataFrame, polls: DataFrame) -> DataFrame:
    """Profiles whose stored access flag differs from the one the sources give."""
    latest = tokens.groupBy("profile_slug").agg(
        F.max_by(
            "has_stored_token", F.struct("observed_at", "api_access_observation_id")
        ).alias("token")
    )
    polled = polls.filter("status = 'ok'").select("profile_slug").distinct().withColumn(
        "polled", F.lit(True)
    )
    both = profiles.filter("profile_key > 0").join(latest, "profile_slug", "left").join(
        polled, "profile_slug", "left"
    )
    expected = F.coalesce("token", F.lit(False)) & F.coalesce("polled", F.lit(False))
    return both.withColumn("expected", expected).filter(
        ~F.col("has_api_access").eqNullSafe(F.col("expected"))
    ).select("profile_slug", "has_api_access", "expected")


def unregistered_profiles(plays: DataFrame, registry: DataFrame) -> DataFrame:
    return plays.select("profile_slug").distinct().join(registry, "profile_slug", "left_anti")


def identical_profiles(records: DataFrame, values: Sequence[str]) -> DataFrame:
    """Profiles holding the same records as another, whatever their order.

    Each one is reported beside the first profile of its group, so a group of n gives n - 1 rows.
    """
    marks = fingerprint(records, ["profile_slug"], values)
    on = [c for c in marks.columns if c != "profile_slug"]
    first = marks.groupBy(*on).agg(F.min("profile_slug").alias("first"))
    return marks.join(first, on).filter(F.col("profile_slug") > F.col("first")).select(
        F.col("first").alias("profile_slug"), F.col("profile_slug").alias("twin"), "row_count"
    )


def slow_loads(records: DataFrame, limit: str = "interval 1 minute") -> DataFrame:
    """Files whose records were not stored in one go."""
    spans = records.groupBy("profile_slug", "source_file").agg(
        F.min("ingested_at").alias("first"), F.max("ingested_at").alias("last")
    )
    return spans.filter(F.col("last") > F.col("first") + F.expr(limit))


def personal_keys(raw: DataFrame, payload: str = "payload") -> DataFrame:
    keys = F.array(*[F.lit(k) for k in EXPORT_PII_KEYS])
    return raw.filter(F.arrays_overlap(F.json_object_keys(payload), keys))


def profile_overlaps(
    records: DataFrame, keys: Sequence[str], pairs: DataFrame,
    limit: float = SETTINGS.profile_overlap_limit,
) -> DataFrame:
    """For each asked pair of profiles, the share of the smaller one's plays the other also holds.

    `pairs`: left_id, right_id. A pair above the limit is one person's export under two names.
    """
    both = pair_overlaps(records, "profile_slug", keys, pairs)
    share = F.col("overlap") / F.least("left_size", "right_size")
    return both.select(
        F.col("left_id").alias("left_profile"), F.col("right_id").alias("right_profile"),
        F.col("overlap").alias("shared"), share.alias("share"), (share > limit).alias("refused"),
    )


def identical_files(listing: DataFrame) -> DataFrame:
    """Digests shared by several files; `listing` is a binaryFile scan of the archives."""
    return listing.select("path", F.md5("content").alias("digest")).groupBy("digest").agg(
        F.count(F.lit(1)).alias("files"), F.min("path").alias("one"), F.max("path").alias("another")
    ).filter("files > 1")
