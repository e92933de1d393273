"""Text helpers used for matching and display. Everything but one Unicode step stays in the JVM."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.config import PLATFORM_PREFIXES

# Punctuation that has an ASCII twin but no Unicode decomposition.
_FANCY = "’‘ʼ`´“”–—"
_PLAIN = "'''''\"\"--"
_APOSTROPHES = "’‘ʼ`"

ISRC = r"^[A-Z]{2}[A-Z0-9]{3}[0-9]{7}$"
MBID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
TRACK_URI = r"^[a-z]+:track:([A-Za-z0-9]{22})$"


@F.pandas_udf(T.StringType())
def _decompose(values: pd.Series) -> pd.Series:
    return values.str.normalize("NFKD")


def fold_text(col: Column) -> Column:
    """Case, accents, quote style and inner spacing folded away.

    Only strings that leave ASCII travel to Python; the others are passed as NULL and cost nothing.
    """
    low = F.lower(F.trim(col))
    foreign = low.rlike(r"[^\x00-\x7F]")
    bare = F.coalesce(_decompose(F.when(foreign, low)), low)
    bare = F.regexp_replace(bare, r"[̀-ͯ]", "")
    return F.regexp_replace(F.translate(bare, _FANCY, _PLAIN), r"\s+", " ")


def content_match_key(name: Column, creator: Column) -> Column:
    """``name|creator`` after folding; NULL when either side is NULL."""
    return F.concat(fold_text(name), F.lit("|"), fold_text(creator))


def normalise_name(col: Column) -> Column:
    """Playlist names compare without case, edge spaces and apostrophe style; NULL is ''."""
    plain = F.translate(col, _APOSTROPHES, "'" * len(_APOSTROPHES))
    return F.coalesce(F.lower(F.trim(plain)), F.lit(""))


def platform_family(col: Column) -> Column:
    low = F.lower(F.trim(col))
    family = F.when(F.coalesce(low, F.lit("")) == "", "not recorded")
    for prefix, name in PLATFORM_PREFIXES:
        family = family.when(low.startswith(prefix), name)
    return family.otherwise("other")


def normalize_isrc(col: Column) -> Column:
    bare = F.upper(F.replace(F.trim(col), F.lit("-"), F.lit("")))
    return F.when(bare.rlike(ISRC), bare)


def is_mbid(col: Column) -> Column:
    return F.coalesce(col.rlike(MBID), F.lit(False))


def track_id_from_uri(col: Column) -> Column:
    return F.nullif(F.regexp_extract(col, TRACK_URI, 1), F.lit(""))


def endpoint_template(col: Column) -> Column:
    """A request path with its catalogue ids masked and its query string removed."""
    return F.regexp_replace(
        F.substring_index(col, "?", 1), r"/[0-9A-Za-z]{22}(?=/|$)", "/{id}"
    )


def duration_text(ms: Column) -> Column:
    """``m:ss``; blank when the duration is unknown."""
    seconds = F.floor(ms / 1000)
    text = F.concat(
        F.floor(seconds / 60).cast("string"), F.lit(":"), F.lpad((seconds % 60).cast("string"), 2, "0")
    )
    return F.coalesce(text, F.lit(""))
