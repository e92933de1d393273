"""Stable surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def play_event_key(slug: Column, uri: Column, ended_at: Column) -> Column:
    """Signed 64-bit key of (profile, content, UTC second); a rebuild never renumbers a play."""
    second = F.date_format(ended_at, "yyyy-MM-dd'T'HH:mm:ss")
    digest = F.md5(F.concat_ws("|", slug, uri, second))
    return F.conv(F.substring(digest, 1, 16), 16, -10).cast("bigint")


def attribute_hash(*cols: Column) -> Column:
    """One digest over tracked attributes; NULL reads as the empty string."""
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", *texts))
