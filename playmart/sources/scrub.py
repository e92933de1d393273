"""Dropping what identifies other people before anything is stored."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.config import EXPORT_PII_KEYS

# Nested paths removed per feed.
REMOVED_PATHS = {
    "me": ("email",),
    "playlist": (
        "items[].owner.id", "items[].owner.display_name", "items[].owner.uri", "items[].owner.href",
        "items[].owner.external_urls", "items[].images",
    ),
    "playlist_item": ("items[].added_by",),
}


def _drop(col: Column, kind: T.DataType, path: list[str]) -> Column:
    """`col` without the field at `path`; a step ending in [] goes into every element."""
    head, *rest = path
    name = head.removesuffix("[]")
    if not isinstance(kind, T.StructType) or name not in kind.fieldNames():
        return col
    if not rest:
        if len(kind.fields) == 1:
            return F.lit(None).cast("void")
        return col.dropFields(f"`{name}`")
    inner = kind[name].dataType
    if head.endswith("[]"):
        if not isinstance(inner, T.ArrayType):
            return col
        return col.withField(
            f"`{name}`", F.transform(col[name], lambda x: _drop(x, inner.elementType, rest))
        )
    return col.withField(f"`{name}`", _drop(col[name], inner, rest))


def _paths(kind: T.DataType, prefix: str = "") -> set[str]:
    if isinstance(kind, T.ArrayType):
        return _paths(kind.elementType, f"{prefix}[]")
    if not isinstance(kind, T.StructType):
        return set()
    found = set()
    for field in kind.fields:
        here = f"{prefix}.{field.name}" if prefix else field.name
        found |= {here} | _paths(field.dataType, here)
    return found


def mark_owner(doc: Column, owner_id: Column) -> Column:
    """Each listed playlist says whether the profile owns it, before the owner is removed."""
    return doc.withField(
        "items",
        F.transform(
            doc["items"],
            lambda p: p.withField("is_owned_by_profile", p["owner"]["id"].eqNullSafe(owner_id)),
        ),
    )


def scrub_payload(df, column: str, feed: str, owner_id: Column | None = None):
    """The frame with the feed's private paths gone from a parsed payload, and the removed paths."""
    doc = F.col(column)
    if feed == "playlist" and owner_id is not None:
        df = df.withColumn(column, mark_owner(doc, owner_id))
    before = df.schema[column].dataType
    for path in REMOVED_PATHS.get(feed, ()):
        df = df.withColumn(column, _drop(F.col(column), df.schema[column].dataType, path.split(".")))
    after = df.schema[column].dataType
    wanted = set(REMOVED_PATHS.get(feed, ()))
    return df, sorted(wanted & (_paths(before) - _paths(after)))


def _without(value: Column, paths: list[list[str]]) -> Column:
    """A variant without the fields at `paths`; what is not mentioned stays, whatever it is."""
    fields = F.try_variant_get(value, F.lit("$"), "map<string,variant>")
    gone = [p[0] for p in paths if len(p) == 1]
    kept = F.map_filter(fields, lambda key, _: ~key.isin(*gone)) if gone else fields
    for head in sorted({p[0] for p in paths if len(p) > 1}):
        below = [p[1:] for p in paths if p[0] == head and len(p) > 1]
        kept = F.transform_values(kept, _inside(head, below))
    return F.when(fields.isNotNull(), F.parse_json(F.to_json(kept))).otherwise(value)


def _inside(head: str, below: list[list[str]]):
    name = head.removesuffix("[]")

    def change(key: Column, value: Column) -> Column:
        if not head.endswith("[]"):
            return F.when(key == name, _without(value, below)).otherwise(value)
        items = F.try_variant_get(value, F.lit("$"), "array<variant>")
        cleaned = F.parse_json(F.to_json(F.transform(items, lambda x: _without(x, below))))
        return F.when((key == name) & items.isNotNull(), cleaned).otherwise(value)

    return change


def scrub_json(payload: Column, feed: str) -> Column:
    """A raw JSON payload without the feed's private paths; unknown keys are kept as they are."""
    paths = [p.split(".") for p in REMOVED_PATHS.get(feed, ())]
    return F.to_json(_without(F.parse_json(payload), paths)) if paths else payload


def scrub_export_record(df):
    """Without the columns that hold addresses and user agents."""
    return df.drop(*EXPORT_PII_KEYS)
