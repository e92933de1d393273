"""Profiles of tables and payloads: what is filled, what is missing, what must not be shown."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.config import (
    HIDDEN_VALUE_FIELDS, IDENTIFIER_FIELDS, IDENTIFIER_SUFFIXES, PERSON_FIELDS, REDACTED,
)
from playmart.functions.text import platform_family
from playmart.operators.ordered import top_per_group
from playmart.session import small_table


# --- Redaction ------------------------------------------------------------------------------------


# Paths a task keeps before it hands them on.
PATHS = 50_000


def names_person(column: str) -> bool:
    return any(step in PERSON_FIELDS for step in column.split("."))


def is_identifier(column: str) -> bool:
    return (
        names_person(column) or column.endswith(IDENTIFIER_SUFFIXES) or column in IDENTIFIER_FIELDS
    )


def hides_values(column: str) -> bool:
    return any(step in HIDDEN_VALUE_FIELDS for step in column.split("."))


def must_redact(column: str) -> bool:
    return is_identifier(column) or hides_values(column)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def redact(df: DataFrame) -> DataFrame:
    """Every column that names or could identify somebody is masked; NULL stays NULL."""
    masked = lambda c: F.when(_quoted(c).isNotNull(), F.lit(REDACTED)).alias(c)
    return df.select(*[masked(c) if must_redact(c) else _quoted(c) for c in df.columns])


def summarised(df: DataFrame) -> DataFrame:
    """Nested values shown as their size, long text as its head, after redaction."""
    out = redact(df)
    shown = []
    for field in out.schema.fields:
        col, kind = _quoted(field.name), field.dataType.typeName()
        if kind == "array":
            col = F.concat(F.lit("list["), F.size(col).cast("string"), F.lit("]"))
        elif kind == "struct":
            col = F.when(
                col.isNotNull(), F.lit(f"object({len(field.dataType.fields)} keys)")
            )
        elif kind == "map":
            col = F.concat(F.lit("object("), F.size(col).cast("string"), F.lit(" keys)"))
        elif kind == "string":
            col = F.when(F.length(col) > 60, F.concat(F.substring(col, 1, 59), F.lit("…"))).otherwise(col)
        shown.append(col.alias(field.name))
    return out.select(*shown)


# --- Columns --------------------------------------------------------------------------------------


def stacked(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One (field, value) row per cell, values as text: the shape every column profile groups by."""
    cells = F.array(
        *[
            F.struct(F.lit(n).alias("position"), F.lit(c).alias("field"),
                     _quoted(c).cast("string").alias("value"))
            for n, c in enumerate(columns)
        ]
    )
    return df.select(*keys, F.explode(cells).alias("cell")).select(*keys, "cell.*")


def column_schema(df: DataFrame) -> DataFrame:
    """Per column: type, filled rows, null rate and one example, from a single aggregate."""
    stats = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("type"),
                F.count(_quoted(f.name)).alias("non_null"),
                F.count(F.lit(1)).alias("total"),
                (F.lit(REDACTED) if must_redact(f.name)
                 else F.min(_quoted(f.name).cast("string"))).alias("example"),
            )
            for f in df.schema.fields
        ]
    )
    rows = df.agg(stats.alias("s")).select(F.explode("s").alias("s")).select("s.*")
    rate = F.round(1 - F.col("non_null") / F.nullif(F.col("total"), F.lit(0)), 4)
    return rows.select(
        "field", "type", "non_null", "total", rate.alias("null_rate"),
        F.when(F.col("non_null") > 0, F.col("example")).alias("example"),
    )


def field_profile(
    df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Per column (and group, with `keys`): type, nulls, distinct values, range, most frequent value.

    Counts and ranges of all columns come out of one plain aggregate; only the filled cells are
    counted per value, with a map-side step, for the distinct values and the mode. Where a column's
    values must not be shown, its range is masked; of a device column the mode is the device family.
    """
    columns = list(columns or df.columns)
    kinds = dict(df.dtypes)
    text = {c: _quoted(c).cast("string") for c in columns}
    stats = F.array(*[
        F.struct(
            F.lit(c).alias("field"), F.lit(kinds[c]).alias("type"), F.count(F.lit(1)).alias("rows"),
            F.count_if(_quoted(c).isNull()).alias("nulls"),
            F.min(text[c]).alias("low"), F.max(text[c]).alias("high"),
        )
        for c in columns
    ])
    summary = df.groupBy(*keys).agg(stats.alias("s")).select(*keys, F.explode("s").alias("s")).select(*keys, "s.*")
    counts = stacked(df, columns, keys).filter(F.col("value").isNotNull()).groupBy(*keys, "field", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    distinct = counts.groupBy(*keys, "field").agg(F.count(F.lit(1)).alias("distinct_values"))
    hidden = F.col("field").isin(*[c for c in columns if hides_values(c)])
    shown = F.when(F.col("field") == "platform", platform_family(F.col("value"))).when(hidden, F.lit(REDACTED)).otherwise(F.col("value"))
    modes = counts.groupBy(*keys, "field", shown.alias("top_value")).agg(F.sum("n").alias("top_count"))
    mode = top_per_group(modes, [*keys, "field"], [F.desc("top_count"), F.asc("top_value")], 1).drop("rank")
    cover = lambda c: F.when(hidden & F.col(c).isNotNull(), F.lit(REDACTED)).otherwise(F.col(c))
    return (
        summary.join(distinct, [*keys, "field"], "left").join(mode, [*keys, "field"], "left")
        .withColumns({"low": cover("low"), "high": cover("high"),
                      "distinct_values": F.coalesce("distinct_values", F.lit(0))})
    )


# --- JSON payloads --------------------------------------------------------------------------------


def _kind(schema: Column) -> Column:
    """JSON type name of a value whose Spark schema text is given."""
    return (
        F.when(schema == "VOID", "null").when(schema == "STRING", "string")
        .when(schema == "BOOLEAN", "boolean").when(schema.startswith("ARRAY"), "array")
        .when(schema.startswith("OBJECT"), "object").otherwise("number")
    )


def _must_redact_key(key: Column) -> Column:
    """`must_redact` for key names that are data."""
    steps = F.split(key, r"\.")
    named = F.arrays_overlap(steps, F.array(*map(F.lit, [*PERSON_FIELDS, *HIDDEN_VALUE_FIELDS])))
    ends = reduce(or_, [key.endswith(x) for x in IDENTIFIER_SUFFIXES], F.lit(False))
    return named | ends | key.isin(*IDENTIFIER_FIELDS)


def payload_keys(
    df: DataFrame, payload: str = "payload", nested: bool = False, examples: bool = False
) -> DataFrame:
    """One row per key of every payload: key and JSON type; with `examples` the text of a single value too.

    Objects and arrays show no value, and a key that names or could identify somebody a mask. With
    `nested`, the keys inside an object-valued key follow as `parent.child`.
    """
    def shown(name: Column, kind: Column, value: Column) -> Column:
        if not examples:
            return F.lit(None).cast("string")
        single = F.when(kind.isin("string", "number", "boolean"), F.try_variant_get(value, F.lit("$"), "string"))
        return F.when(single.isNotNull() & _must_redact_key(name), F.lit(REDACTED)).otherwise(single)

    pairs = F.from_json(F.col(payload), "map<string,variant>")
    top = df.select(F.explode(pairs).alias("key", "value")).withColumn(
        "kind", _kind(F.schema_of_variant("value"))
    )
    if not nested:
        return top.select("key", "kind", shown(F.col("key"), F.col("kind"), F.col("value")).alias("value"))
    inner = F.when(
        F.col("kind") == "object",
        F.map_entries(F.try_variant_get("value", F.lit("$"), "map<string,variant>")),
    )
    own = F.struct(F.col("key").alias("key"), F.col("kind").alias("kind"), shown(F.col("key"), F.col("kind"), F.col("value")).alias("value"))
    below = F.transform(
        F.coalesce(inner, F.expr("cast(array() as array<struct<key:string,value:variant>>)")),
        lambda e: F.struct(
            F.concat(F.col("key"), F.lit("."), e["key"]).alias("key"),
            _kind(F.schema_of_variant(e["value"])).alias("kind"),
            shown(F.concat(F.col("key"), F.lit("."), e["key"]), _kind(F.schema_of_variant(e["value"])), e["value"]).alias("value"),
        ),
    )
    return top.select(F.explode(F.concat(F.array(own), below)).alias("k")).select("k.*")


def payload_key_schema(
    df: DataFrame, payload: str = "payload", nested: bool = False, examples: bool = False
) -> DataFrame:
    """Per key: the types seen, how many payloads carry a value, and the share that do; one example if asked."""
    total = df.agg(F.count(F.lit(1))).scalar()
    pairs = payload_keys(df, payload, nested, examples).groupBy("key", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("value")
    )
    # six JSON types exist, so the set per key is of fixed size
    found = pairs.groupBy("key").agg(
        F.array_join(F.array_sort(F.collect_set("kind")), "|").alias("types"),
        F.sum("n").alias("present"),
        F.coalesce(F.sum(F.when(F.col("kind") != "null", F.col("n"))), F.lit(0)).alias("non_null"),
        F.min("value").alias("example"),
    ).withColumn("non_null_share", F.round(F.col("non_null") / total, 4))
    return found if examples else found.drop("example")


def _shape(text: str | None) -> set[tuple[str, str | None]]:
    """(path, JSON type) of everything in one document, without recursion into its values."""
    if text is None:
        return {("$", None)}
    found, left = set(), [("$", json.loads(text))]
    while left:
        path, node = left.pop()
        if isinstance(node, dict):
            kind = "object"
            left += [(f"{path}.{k}", v) for k, v in node.items()]
        elif isinstance(node, list):
            kind = "array"
            left += [(f"{path}[]", v) for v in node]
        else:
            kind = {str: "string", bool: "boolean", type(None): "null"}.get(type(node), "number")
        found.add((path, kind))
    return found


def describe_shape(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Every key path and the JSON types seen there, never values; one scan, whatever the depth.

    A task keeps the paths it has seen, hands them on when there are many, and they are merged by path.
    """

    def run(batches):
        seen: set = set()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in seen], pa.string()), pa.array([x[1] for x in seen], pa.string())], names=["path", "kind"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen |= _shape(text)
                if len(seen) > PATHS:
                    yield out()
                    seen.clear()
        yield out()

    return df.select(F.col(payload).cast("string")).mapInArrow(run, "path string, kind string").groupBy("path").agg(
        F.array_join(F.array_sort(F.collect_set("kind")), "|").alias("types")
    )


def schema_frame(records: DataFrame, documented: Sequence[str], payload: str = "payload",
                 conditional: Sequence[str] = ()) -> DataFrame:
    """Presence, null rate, types and an example per field and sub-field, beside what the documentation promises.

    The null rate is over all records: a field that half of them lack is null there. A documented
    field no record carries is a row of its own, typed ABSENT; a sub-field is documented when its
    parent is.
    """
    total = records.agg(F.count(F.lit(1))).scalar()
    seen = payload_key_schema(records, payload, nested=True, examples=True).select(
        F.col("key").alias("field"), "types", "present", "non_null", "example",
        F.substring_index("key", ".", 1).alias("name"),
    )
    promised = small_table(
        records.sparkSession, [(name, name in conditional) for name in documented],
        "name string, conditional boolean",
    )
    joined = seen.join(promised, "name", "full_outer")
    return joined.select(
        F.coalesce("field", "name").alias("field"), F.coalesce("types", F.lit("ABSENT")).alias("types"),
        F.coalesce("present", F.lit(0)).alias("present"),
        F.round(1 - F.coalesce("non_null", F.lit(0)) / F.nullif(F.lit(total), F.lit(0)), 4).alias("null_rate"),
        F.when(F.col("types").isNull() & F.col("conditional"), "yes (conditional)")
        .when(F.col("conditional").isNotNull(), "yes").otherwise("no").alias("documented"),
        (F.coalesce("present", F.lit(0)) == total).alias("on_every_record"), "example",
    )


def field_presence(records: DataFrame, watched: Sequence[str], payload: str = "payload") -> DataFrame:
    """For each watched field: absent, partly present, present, or not examined at all."""
    keys = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
    counts = F.array(
        *[
            F.struct(F.lit(name).alias("field"),
                     F.count_if(F.array_contains(keys, name)).alias("present"),
                     F.count(F.lit(1)).alias("examined"))
            for name in watched
        ]
    )
    rows = records.agg(counts.alias("c")).select(F.explode("c").alias("c")).select("c.*")
    state = (
        F.when(F.col("examined") == 0, "not examined").when(F.col("present") == 0, "absent")
        .when(F.col("present") < F.col("examined"), "partly present").otherwise("present")
    )
    return rows.withColumn("state", state)


def presence_by_kind(
    records: DataFrame, watched: Sequence[tuple[str, str]], kind: str = "kind", payload: str = "payload"
) -> DataFrame:
    """`field_presence` for watched (object kind, field) pairs over objects of many kinds, in one pass.

    Objects are counted per kind once; a kind of which none came is `not examined`.
    """
    keys = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
    wanted = small_table(records.sparkSession, watched, "object string, field string")
    names = sorted({name for _, name in watched})
    counted = F.array(*[
        F.struct(F.lit(n).alias("field"), F.count_if(F.array_contains(keys, n)).alias("present")) for n in names
    ])
    found = records.groupBy(F.col(kind).alias("object")).agg(
        F.count(F.lit(1)).alias("examined"), counted.alias("c")
    ).select("object", "examined", F.explode("c").alias("c")).select("object", "examined", "c.*")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("present", "examined")}
    rows = wanted.join(found, ["object", "field"], "left").withColumns(zero)
    state = (
        F.when(F.col("examined") == 0, "not examined").when(F.col("present") == 0, "absent")
        .when(F.col("present") < F.col("examined"), "partly present").otherwise("present")
    )
    return rows.withColumn("state", state)


# --- Facts about the sources ----------------------------------------------------------------------


def api_window_facts(plays: DataFrame, polls: DataFrame) -> DataFrame:
    """First and last play per profile and source, and plays from before the first good poll."""
    first = polls.filter("status = 'ok'").groupBy("profile_slug").agg(
        F.min("finished_at").alias("first_poll")
    )
    joined = plays.join(first, "profile_slug")
    return joined.groupBy("profile_slug", "source_system").agg(
        F.min("ended_at_utc").alias("first_play"), F.max("ended_at_utc").alias("last_play"),
        F.count(F.lit(1)).alias("plays"),
        F.count_if(F.col("ended_at_utc") < F.col("first_poll")).alias("before_first_poll"),
    )


def gap_evidence(plays: DataFrame) -> DataFrame:
    """Plays and missing durations per source and content type."""
    return plays.groupBy("source_system", "content_type").agg(
        F.count(F.lit(1)).alias("plays"),
        (F.count(F.lit(1)) - F.count("ms_played")).alias("null_durations"),
    )


def captured_item_types(raw: DataFrame) -> DataFrame:
    """How many captured items carry each track type; `missing` where none is said."""
    kinds = F.from_json("payload", "items array<struct<track struct<type string>>>")
    items = raw.filter("feed = 'recently_played'").select(F.explode(kinds["items"]).alias("item"))
    return items.groupBy(F.coalesce("item.track.type", F.lit("missing")).alias("type")).agg(
        F.count(F.lit(1)).alias("items")
    )


def export_section(records: DataFrame) -> DataFrame:
    """Files, span and content types of each profile's export."""
    per_file = records.groupBy("profile_slug", "source_file").agg(
        F.count(F.lit(1)).alias("n"), F.min("ended_at_utc").alias("first"),
        F.max("ended_at_utc").alias("last"),
        *[F.count_if(F.col("content_type") == k).alias(k)
          for k in ("track", "episode", "audiobook_chapter")],
    )
    return per_file.groupBy("profile_slug").agg(
        F.count(F.lit(1)).alias("files"), F.sum("n").alias("records"),
        F.to_date(F.min("first")).alias("first_day"), F.to_date(F.max("last")).alias("last_day"),
        *[F.sum(k).alias(k) for k in ("track", "episode", "audiobook_chapter")],
    )


def lookup_section(lookups: DataFrame) -> DataFrame:
    """How many recording codes were looked up, found, and led to one external artist."""
    return lookups.agg(
        F.count(F.lit(1)).alias("looked_up"), F.count_if("is_found").alias("found"),
        F.count("primary_artist_mbid").alias("resolved"),
        F.round(F.lit(100.0) * F.count_if("is_found") / F.nullif(F.count(F.lit(1)), F.lit(0)), 2).alias(
            "pct_found"
        ),
    )


def vocabulary_section(current: DataFrame) -> DataFrame:
    """How the strings of each vocabulary spread over artists: used once, by several, at most."""
    per_string = current.groupBy("tag_type", "tag_name").agg(F.count(F.lit(1)).alias("artists"))
    return per_string.groupBy("tag_type").agg(
        F.count(F.lit(1)).alias("strings"), F.sum("artists").alias("uses"),
        F.count_if(F.col("artists") == 1).alias("used_once"), F.max("artists").alias("most_used"),
    )


def fact_section(fact: DataFrame) -> DataFrame:
    return fact.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("plays"), F.count("ms_played").alias("rows_with_duration"),
        F.count_if("is_qualified_play").alias("qualified"),
        F.count_if(F.col("content_key") == -1).alias("unknown_content"),
    )


def content_section(content: DataFrame) -> DataFrame:
    return content.groupBy("content_type", "is_resolved").agg(
        F.count(F.lit(1)).alias("items"), F.count("duration_ms").alias("with_duration"),
        F.count("primary_creator_name").alias("with_creator"),
    )


def artist_section(artists: DataFrame) -> DataFrame:
    per = artists.filter("artist_key > 0").groupBy("artist_id").agg(
        F.count(F.lit(1)).alias("versions"), F.bool_or(F.col("genre_source").isNotNull()).alias("sourced")
    )
    return per.groupBy("versions").agg(
        F.count(F.lit(1)).alias("artists"), F.count_if("sourced").alias("with_genre_source")
    )


def weights_hold(bridge: DataFrame) -> DataFrame:
    """Whether every (artist, vocabulary) adds up to one, per vocabulary."""
    sums = bridge.groupBy("tag_type", "artist_key").agg(F.sum("weight_factor").alias("w"))
    return sums.groupBy("tag_type").agg(
        F.count(F.lit(1)).alias("artists"),
        F.bool_and(F.abs(F.col("w") - 1) <= 1e-6).alias("weights_sum_to_one"),
    )


def reconciliation_holds(steps: DataFrame, plays: DataFrame) -> DataFrame:
    """Whether the chain starts at all plays and loses exactly what it names, per profile."""
    total = plays.groupBy("profile_slug").agg(F.count(F.lit(1)).alias("plays"))
    chain = steps.groupBy("profile_slug").agg(
        F.max(F.when(F.col("step_number") == 1, F.col("play_count"))).alias("first_step"),
        F.max(F.when(F.col("step_number") == 4, F.col("play_count"))).alias("last_step"),
        F.sum("residual_play_count").alias("lost"),
    )
    return chain.join(total, "profile_slug").select(
        "profile_slug",
        ((F.col("first_step") == F.col("plays"))
         & (F.col("last_step") + F.col("lost") == F.col("plays"))).alias("holds"),
    )


def table_catalog(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Name, rows and columns of every table, counted in one job."""
    rows = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("name"), "rows", F.lit(len(df.columns)).alias("columns"),
            F.lit(", ".join(df.columns)).alias("fields"),
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows
