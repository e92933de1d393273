"""Writing: validated appends, extracts, and rebuilds that prove themselves first."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playmart.config import EXPORT_PII_KEYS
from playmart.sources.readers import SourceError

FEED_NAME = r"^[a-z][a-z0-9_]*$"
# The external source and its two feeds.
EXTERNAL_SOURCES = ("musicbrainz",)
EXTERNAL_FEEDS = ("isrc", "artist")


class BatchRefused(SourceError):
    """A batch that was not published; `broken` counts its rows per broken rule."""

    def __init__(self, batch: str, broken: dict[str, int]):
        super().__init__(f"batch {batch!r} is not published; rows that break a rule: {broken}")
        self.broken = broken


def broken_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking at least one rule, with the names of the rules in `broken`."""
    names = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    )
    return df.withColumn("broken", names).filter(F.size("broken") > 0)


def response_rules() -> dict[str, Column]:
    return {"feed name": F.col("feed").rlike(FEED_NAME), "payload": F.col("payload").isNotNull()}


def external_rules(
    sources: Sequence[str] = EXTERNAL_SOURCES, feeds: Sequence[str] = EXTERNAL_FEEDS
) -> dict[str, Column]:
    return {"source": F.col("source").isin(*sources), "feed": F.col("feed").isin(*feeds)}


def export_rules() -> dict[str, Column]:
    keys = F.json_object_keys("payload")
    pii = F.arrays_overlap(keys, F.array(*[F.lit(k) for k in EXPORT_PII_KEYS]))
    return {"no PII": ~pii, "record_index": F.col("record_index") >= 0}


def poll_rules() -> dict[str, Column]:
    ok = F.col("status") == "ok"
    return {
        "status": F.col("status").isin("ok", "error"),
        "ok needs a response": ok == F.col("raw_id").isNotNull(),
    }


def gap_rules() -> dict[str, Column]:
    return {"gap has a length": F.col("gap_end") > F.col("gap_start")}


def guarded(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The frame itself; Spark stops the job at the first row that breaks a rule."""
    out = df
    for name, ok in rules.items():
        probe = F.when(
            ~F.coalesce(ok, F.lit(False)), F.raise_error(F.lit(f"rule broken: {name}"))
        )
        out = out.filter(probe.isNull())
    return out


def append_responses(
    df: DataFrame, path: str, rules: dict[str, Column], partition: Sequence[str] = ("feed",)
) -> None:
    guarded(df, rules).write.mode("append").partitionBy(*partition).parquet(path)


def violations(df: DataFrame, rules: dict[str, Column], name: str) -> tuple[DataFrame, Observation]:
    """The frame itself, and how many of its rows break each rule, counted while it is written.

    A rule that is NULL for a row counts as broken. The numbers are there once an action has run.
    """
    seen = Observation(name)
    broken = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(rule) for rule, ok in rules.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *broken), seen


def append_observed(
    df: DataFrame, path: str, rules: dict[str, Column], batch: str, partition: Sequence[str] = ("feed",)
) -> int:
    """Append one batch if no row breaks a rule; the error names every broken rule and its rows.

    Rules are counted in the pass that writes. The rows go to a folder readers skip (its name starts
    with `_`); the batch appears as the partition `batch=<batch>` by renaming that one folder, so it is
    there whole or not at all. A refused batch stays in the hidden folder for inspection; writing it
    again replaces it. A batch already published is not written again. Returns the rows written.
    """
    if not re.fullmatch(r"[A-Za-z0-9-]+", batch):
        raise SourceError(f"a batch is named by letters, digits and hyphens: {batch!r}")
    if "rows" in rules:
        raise SourceError("no rule may be called rows")
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path
    hidden, shown = folder(f"{path}/_held-{batch}"), folder(f"{path}/batch={batch}")
    files = shown.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(shown):
        raise SourceError(f"batch {batch!r} is already there")
    checked, seen = violations(df, rules, f"append {batch}")
    checked.write.mode("overwrite").partitionBy(*partition).parquet(str(hidden.toString()))
    found = seen.get
    broken = {rule: found[rule] for rule in rules if found.get(rule)}
    if broken:
        raise BatchRefused(batch, broken)
    if not files.rename(hidden, shown):
        raise SourceError(f"batch {batch!r} could not be published")
    return found.get("rows", 0)


def fingerprint(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows and an order-free fingerprint per key: partial sums only, no ordered collect."""
    h = F.xxhash64(*values)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.shiftright(h, 32)).alias("fingerprint_high"),
        F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))).alias("fingerprint_low"),
        F.bit_xor(h).alias("fingerprint_xor"),
    )


def changed_fingerprints(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose count or fingerprint differs, or that exist on one side only."""
    marks = ["row_count", "fingerprint_high", "fingerprint_low", "fingerprint_xor"]
    same = before.select(*keys, *marks)
    return same.unionByName(after.select(*keys, *marks)).groupBy(*keys, *marks).count().filter(
        "count < 2"
    ).select(*keys).distinct()


def rebuild_with_control(
    spark: SparkSession, current: str, rebuilt: DataFrame, staging: str, control: str,
    keys: Sequence[str], values: Sequence[str],
) -> str:
    """Write the rebuild beside the current table; hand its path over only if the control holds.

    Nothing is truncated: the caller switches its pointer to the returned path.
    """
    rebuilt.write.mode("errorifexists").partitionBy(*keys[:1]).parquet(staging)
    is_control = F.col(keys[0]) == control
    before = fingerprint(spark.read.parquet(current).filter(is_control), keys, values)
    after = fingerprint(spark.read.parquet(staging).filter(is_control), keys, values)
    if not changed_fingerprints(before, after, keys).isEmpty():
        raise SourceError(f"the control {control!r} changed; the rebuild stays at {staging}")
    return staging


def backfill_feed(raw: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Fill `feed` from the name of the landing file; a row no pattern fits stops the job."""
    feed = F.lit(None).cast("string")
    for name, pattern in patterns.items():
        feed = F.coalesce(feed, F.when(F.col("source_file").like(pattern), F.lit(name)))
    return guarded(raw.withColumn("feed", feed), {"every file has a feed": F.col("feed").isNotNull()})


def backfill_checked(
    spark: SparkSession, current: str, target: str, patterns: dict[str, str]
) -> str:
    """Write `current` with its feeds filled in, and prove that no other column has changed.

    The proof is one order-free fingerprint over all old columns, of the rows as they are and as they
    are read back from `target`; a difference raises and leaves `current` the valid table.
    """
    raw = spark.read.parquet(current)
    backfill_feed(raw, patterns).write.mode("errorifexists").parquet(target)
    old = [c for c in raw.columns if c != "feed"]
    marks = [fingerprint(spark.read.parquet(p).select(*old), [], old) for p in (current, target)]
    if marks[0].first() != marks[1].first():
        raise SourceError(f"older columns changed during the backfill; {current} stays valid")
    return target


def write_extract(df: DataFrame, path: str) -> None:
    """CSV with a header. Files follow Spark's partitions; a spreadsheet-sized extract has one."""
    df.write.mode("overwrite").option("dateFormat", "yyyy-MM-dd").csv(path, header=True)


def sheet_path(folder: str, playlist: str) -> str:
    """Where a playlist's sheet goes; what a file system may refuse becomes an underscore."""
    safe = "".join(c if c.isalnum() or c in "-_" else "_" for c in playlist)
    return f"{folder}/playlist_{safe}.csv"


def write_sheet(sheet: DataFrame, folder: str, playlist: str, order: str = "order_number") -> str:
    """One playlist as CSV in playlist order; returns the path."""
    path = sheet_path(folder, playlist)
    write_extract(sheet.orderBy(order), path)
    return path
