"""Comparing playlists in one direction at a time, and one playlist as a sheet.

A comparison frame has one row per track: content_uri, isrc, content_match_key, and display columns.
The three keys are the tiers, from the strictest to the loosest.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.text import (
    content_match_key, duration_text, normalise_name,
)
from playmart.operators.ordered import ranked, split_scan
from playmart.operators.sets import pair_overlaps, tagged
from playmart.session import small_table

TIERS = ("content_uri", "isrc", "content_match_key")
TIER_LABELS = {"content_uri": "uri", "isrc": "isrc", "content_match_key": "name"}


class PlaylistNameError(LookupError):
    """A name fits no playlist, or several; the message lists what was found."""


@dataclass(frozen=True)
class DirectionalMiss:
    left_name: str
    right_name: str
    tier: str
    rows: DataFrame
    left: DataFrame

    @property
    def label(self) -> str:
        return f"Tracks in {self.left_name} that are not in {self.right_name}"

    def sizes(self) -> DataFrame:
        """One row: misses, size of the left side, and how many of it carry the tier's key."""
        carried = self.left.agg(
            F.count(F.lit(1)).alias("of"), F.count(self.tier).alias("with_key")
        )
        missed = self.rows.agg(F.count(F.lit(1))).scalar()
        return carried.select(
            F.lit(self.label).alias("direction"), F.lit(self.tier).alias("tier"),
            missed.alias("misses"), "of", "with_key",
        )


def load_membership(
    membership: DataFrame, playlists: DataFrame, content: DataFrame, details: DataFrame,
    per_playlist: bool = False,
) -> DataFrame:
    """Members at the newest snapshot (of all playlists, or of each) with every tier's key.

    The match key comes from the entry's own names when the content is unknown.
    """
    if per_playlist:
        newest = membership.groupBy("playlist_key").agg(F.max("snapshot_date").alias("snapshot_date"))
        now = membership.join(newest, ["playlist_key", "snapshot_date"], "left_semi")
    else:
        newest = membership.agg(F.max("snapshot_date")).scalar()
        now = membership.filter(F.col("snapshot_date") == newest)
    known = content.select(
        "content_key", F.col("content_name").alias("c_name"), "parent_name",
        F.col("primary_creator_name").alias("c_creator"), F.col("content_match_key").alias("c_key"),
    )
    codes = details.select("content_key", F.col("isrc").alias("c_isrc"))
    rows = now.join(playlists.select("playlist_key", "playlist_name"), "playlist_key").join(
        known, "content_key", "left"
    ).join(codes, "content_key", "left")
    own = content_match_key(
        F.coalesce("content_name", F.lit("")), F.coalesce("primary_creator_name", F.lit(""))
    )
    return rows.select(
        "playlist_name", "snapshot_date",
        F.coalesce("primary_creator_name", "c_creator").alias("artist"),
        F.coalesce("content_name", "c_name").alias("title"), F.col("parent_name").alias("album"),
        "content_uri", F.coalesce("isrc", "c_isrc").alias("isrc"),
        F.coalesce(F.col("c_key"), own).alias("content_match_key"),
        F.col("content_key").isNotNull().alias("in_dim_content"),
    )


def misses(
    left: DataFrame, right: DataFrame, tier: str, left_name: str = "left", right_name: str = "right"
) -> DirectionalMiss:
    """Rows of left whose key is not in right. A row without a key is a miss: NULL never matches."""
    if tier not in TIERS:
        raise ValueError(f"{tier!r} is not one of {TIERS}")
    rows = left.join(right.select(tier), tier, "left_anti").select(*left.columns)
    return DirectionalMiss(left_name, right_name, tier, rows, left)


def _known(right: DataFrame, tier: str, flag: str, on: Sequence[str]) -> DataFrame:
    return right.filter(F.col(tier).isNotNull()).select(*on, tier).distinct().withColumn(
        flag, F.lit(True)
    )


def tier_flags(left: DataFrame, right: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """Left with one boolean per tier: is this row's key in right. `on` scopes the comparison."""
    out = left
    for tier, label in TIER_LABELS.items():
        flag = f"in_{label}"
        out = out.join(_known(right, tier, flag, on), [*on, tier], "left").withColumn(
            flag, F.coalesce(flag, F.lit(False))
        )
    return out


def tier_table(left: DataFrame, right: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """All tiers side by side from one aggregate: misses, size, and rows carrying the key."""
    flags = tier_flags(left, right, on)
    cells = F.array(
        *[
            F.struct(
                F.lit(label).alias("tier"), F.count_if(~F.col(f"in_{label}")).alias("misses"),
                F.count(F.lit(1)).alias("of"), F.count(tier).alias("with_key"),
            )
            for tier, label in TIER_LABELS.items()
        ]
    )
    return flags.groupBy(*on).agg(cells.alias("c")).select(*on, F.explode("c").alias("c")).select(
        *on, "c.*"
    )


def identifier_misses(left: DataFrame, right: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """Neither uri nor recording code is on the other side; `cleared_by_name` marks loose matches."""
    flags = tier_flags(left, right, on)
    return flags.filter(~F.col("in_uri") & ~F.col("in_isrc")).withColumnRenamed(
        "in_name", "cleared_by_name"
    ).drop("in_uri", "in_isrc")


def strict_misses(left: DataFrame, right: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    return identifier_misses(left, right, on).filter(~F.col("cleared_by_name"))


def split_misses(left: DataFrame, right: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """Every uri-miss, as absent at all tiers or as the same work under another uri.

    A re-housed row shows the tier that found it and the other side's album and uri, by recording
    code where that works, else by name; the smallest uri stands for its duplicates.
    """
    flags = tier_flags(left, right, on).filter(~F.col("in_uri"))

    def other(tier: str, tag: str) -> DataFrame:
        pick = F.struct("content_uri", "album")
        return right.filter(F.col(tier).isNotNull()).groupBy(*on, tier).agg(
            F.min_by(pick, "content_uri").alias(tag)
        )

    both = flags.join(other("isrc", "by_isrc"), [*on, "isrc"], "left").join(
        other("content_match_key", "by_name"), [*on, "content_match_key"], "left"
    )
    tier = (
        F.when(F.col("in_isrc") & F.col("in_name"), "isrc + name").when(F.col("in_isrc"), "isrc")
        .when(F.col("in_name"), "name")
    )
    found = F.when(F.col("in_isrc"), F.col("by_isrc")).otherwise(F.col("by_name"))
    return both.withColumns({"matched_tier": tier, "__found": found}).select(
        *left.columns, "matched_tier", F.col("matched_tier").isNull().alias("is_absent"),
        F.col("__found.album").alias("album_other_side"),
        F.col("__found.content_uri").alias("uri_other_side"),
    )


def tier_nesting(left: DataFrame, right: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """Is a miss at a looser tier always a miss at a stricter one, and how far the tiers differ."""
    miss = lambda label: ~F.col(f"in_{label}")
    flags = tier_flags(left, right, on)
    return flags.groupBy(*on).agg(
        (F.count_if(miss("isrc") & ~miss("uri")) == 0).alias("isrc_inside_uri"),
        (F.count_if(miss("name") & ~miss("uri")) == 0).alias("name_inside_uri"),
        (F.count_if(miss("name") & ~miss("isrc")) == 0).alias("name_inside_isrc"),
        F.count_if(miss("uri") & ~miss("isrc")).alias("uri_not_isrc"),
        F.count_if(miss("isrc") & ~miss("name")).alias("isrc_not_name"),
    )


def overlap_metrics(members: DataFrame, pairs: DataFrame, key: str = "content_uri") -> DataFrame:
    """Overlap, Jaccard and coverage for the asked pairs of playlists.

    `members`: playlist_id and the key; `pairs`: left_id, right_id.
    """
    out = pair_overlaps(members, "playlist_id", [key], pairs)
    union = F.col("left_size") + F.col("right_size") - F.col("overlap")
    return out.select(
        "left_id", "right_id", "left_size", "right_size", "overlap",
        (F.col("overlap") / union).alias("jaccard"),
        (F.col("overlap") / F.col("left_size")).alias("coverage"),
        (F.col("left_size") - F.col("overlap")).alias("left_misses"),
    )


def load_playlists(playlists: DataFrame, membership: DataFrame) -> DataFrame:
    """Current playlists with how many of their tracks were loaded."""
    loaded = membership.groupBy("playlist_key").agg(F.count("content_uri").alias("tracks_loaded"))
    return (
        playlists.filter("is_current and playlist_key > 0")
        .join(loaded, "playlist_key", "left")
        .select(
            "playlist_name", "track_total", "is_owned_by_profile", "is_collaborative", "is_public",
            F.to_date("valid_from").alias("first_seen"),
            F.coalesce("tracks_loaded", F.lit(0)).alias("tracks_loaded"),
        )
    )


def empty_playlists(playlists: DataFrame, membership: DataFrame) -> DataFrame:
    return playlists.filter("is_current and playlist_key > 0").join(
        membership, "playlist_key", "left_anti"
    )


def orphan_summary(membership: DataFrame, content: DataFrame) -> DataFrame:
    """Members whose content is unknown, as rows and as distinct tracks."""
    per_uri = membership.groupBy("content_uri").agg(F.count(F.lit(1)).alias("n"))
    marked = tagged(per_uri, content, ["content_uri"], "known")
    lost = ~F.col("known")
    return marked.agg(
        F.sum("n").alias("membership_rows"),
        F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("rows_without_content"),
        F.count(F.lit(1)).alias("distinct_tracks"),
        F.count_if(lost).alias("distinct_tracks_without_content"),
    )


def name_matches(
    names: DataFrame, needles: Sequence[str], column: str = "playlist_name"
) -> DataFrame:
    """Resolve every typed name: an exact folded match wins, else the only name containing it.

    The result says how many names fit exactly and loosely, and the resolved name with whether it
    was exact; no name when nothing or several fit. The table of names is read once.
    """
    asked = F.array(
        *[F.struct(F.lit(n).alias("needle"), normalise_name(F.lit(n)).alias("t")) for n in needles]
    )
    folded = names.select(column).distinct().withColumn("__n", normalise_name(F.col(column)))
    near = F.filter(asked, lambda a: F.col("__n").contains(a["t"]))
    found = folded.select(column, "__n", F.explode(near).alias("a"))
    exact = F.col("__n") == F.col("a.t")
    counts = found.groupBy("a.needle").agg(
        F.count_if(exact).alias("exact_names"), F.min(F.when(exact, F.col(column))).alias("exact_name"),
        F.count(F.lit(1)).alias("loose_names"), F.min(column).alias("loose_name"),
    )
    one = F.when(F.col("exact_names") == 1, F.col("exact_name")).when(
        (F.col("exact_names") == 0) & (F.col("loose_names") == 1), F.col("loose_name")
    )
    every = small_table(names.sparkSession, [(n,) for n in needles], "needle string")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("exact_names", "loose_names")}
    return every.join(counts, "needle", "left").withColumns(zero).select(
        "needle", "exact_names", "loose_names", one.alias("resolved"),
        (F.col("exact_names") == 1).alias("is_exact"),
    )


def _grams(text: Column, size: int) -> Column:
    """All pieces of `size` code points; the empty piece for size 0."""
    if size == 0:
        return F.array(F.lit(""))
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - (size - 1)))
    return F.transform(F.coalesce(places, F.array().cast("array<int>")), lambda i: F.substring(text, i, F.lit(size)))


def resolve_names(
    names: DataFrame, asked: DataFrame, column: str = "playlist_name", needle: str = "needle"
) -> DataFrame:
    """`name_matches` for a table of typed names: one row per distinct one, with its `outcome`.

    exact: one name equals it (folded); only: no equal, one name contains it; none; several.
    A NULL name is nobody's and a NULL needle is not asked.

    Names are filed under their pieces of three code points. Each needle is looked up under the rarest
    of its own (a shorter one under the whole of itself) and what is found there is compared in full,
    so a needle meets only names that hold its rarest piece.
    """
    folded = names.select(F.col(column).alias("name")).dropna().distinct().withColumn("n", normalise_name(F.col("name")))
    typed = asked.select(F.col(needle).alias("needle")).dropna().distinct().withColumn("t", normalise_name(F.col("needle")))
    short = F.length("t")
    own = typed.select("needle", "t", F.explode(
        F.when(short == 0, _grams(F.col("t"), 0)).when(short == 1, _grams(F.col("t"), 1))
        .when(short == 2, _grams(F.col("t"), 2)).otherwise(F.array_distinct(_grams(F.col("t"), 3)))
    ).alias("gram"))
    pieces = F.array_distinct(F.flatten(F.array(*[_grams(F.col("n"), size) for size in range(4)])))
    filed = folded.select("name", "n", F.explode(pieces).alias("gram")).join(
        own.select("gram").distinct(), "gram", "left_semi"
    )
    sizes = filed.groupBy("gram").agg(F.count(F.lit(1)).alias("names"))
    # a piece that no name holds rules the needle out: it is the rarest and meets nothing
    rarest = own.join(sizes, "gram", "left").groupBy("needle", "t").agg(
        F.min_by("gram", F.struct(F.coalesce("names", F.lit(0)), F.col("gram"))).alias("gram")
    )
    met = rarest.join(filed, "gram").filter(F.col("n").contains(F.col("t")))
    exact = F.col("n") == F.col("t")
    counts = met.groupBy("needle").agg(
        F.count_if(exact).alias("exact_names"), F.min(F.when(exact, F.col("name"))).alias("exact_name"),
        F.count(F.lit(1)).alias("loose_names"), F.min("name").alias("loose_name"),
    )
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("exact_names", "loose_names")}
    none_equal = F.col("exact_names") == 0
    outcome = (
        F.when(F.col("exact_names") == 1, "exact").when(none_equal & (F.col("loose_names") == 1), "only")
        .when(F.col("loose_names") == 0, "none").otherwise("several")
    )
    resolved = F.when(F.col("outcome") == "exact", F.col("exact_name")).when(
        F.col("outcome") == "only", F.col("loose_name")
    )
    return typed.select("needle").join(counts, "needle", "left").withColumns(zero).withColumn(
        "outcome", outcome
    ).select("needle", "exact_names", "loose_names", resolved.alias("resolved"), "outcome")


def resolve_name(names: DataFrame, needle: str, column: str = "playlist_name") -> tuple[str, bool]:
    """The one name that fits and whether it fits exactly; an error names the candidates."""
    row = name_matches(names, [needle], column).first()
    if row["resolved"] is not None:
        return row["resolved"], row["is_exact"]
    near = [r[0] for r in candidates(names, needle, column).limit(15).collect()]
    raise PlaylistNameError(
        f"{needle!r} fits {row['loose_names']} playlist(s), among them: {near or 'none'}"
    )


def candidates(names: DataFrame, needle: str, column: str = "playlist_name") -> DataFrame:
    target = normalise_name(F.lit(needle))
    return names.filter(normalise_name(F.col(column)).contains(target)).select(
        column
    ).distinct().orderBy(column)


def any_word_candidates(
    playlists: DataFrame, membership: DataFrame, needle: str, top: int = 15
) -> DataFrame:
    """Current playlists whose name holds any word of the needle, fullest first."""
    words = [word for word in needle.replace("'", " ").split() if len(word) > 2] or [needle]
    hit = F.lit(False)
    for word in words:
        hit = hit | F.col("playlist_name").ilike(f"%{word}%")
    loaded = membership.groupBy("playlist_key").agg(F.count("content_uri").alias("loaded"))
    return (
        playlists.filter(F.col("is_current") & hit).join(loaded, "playlist_key", "left")
        .groupBy("playlist_name", "track_total")
        .agg(F.sum(F.coalesce("loaded", F.lit(0))).alias("loaded"))
        .orderBy(F.desc("loaded"), "playlist_name").limit(top)
    )


# --- The sheet ------------------------------------------------------------------------------------

ANNOTATIONS = ("key", "bpm", "notes")


def best_genre(credits: DataFrame, artist_genres: DataFrame, genres: DataFrame) -> DataFrame:
    """One label per content: the curated vocabulary before the loose one, then votes, then name.

    The label hangs on the artist, so it is chosen per artist before content is joined.
    """
    named = artist_genres.join(genres.select("genre_key", "genre_name"), "genre_key")
    order = F.struct(
        (F.col("tag_type") != "genre").cast("int"), -F.coalesce("vote_count", F.lit(-1)), "genre_name"
    )
    label = named.groupBy("artist_key").agg(F.min_by("genre_name", order).alias("genre"))
    primary = credits.filter("is_primary").select("content_key", "artist_key")
    return primary.join(label, "artist_key").select("content_key", "genre")


def listening_of(plays: DataFrame) -> DataFrame:
    """Plays, time and span per content of the profile whose plays are given."""
    return plays.groupBy("content_key").agg(
        F.count(F.lit(1)).alias("plays"), F.count_if("is_qualified_play").alias("qualified_plays"),
        F.sum("ms_played").alias("ms_played"), F.min("ended_at_utc").alias("first_played"),
        F.max("ended_at_utc").alias("last_played"),
    )


def playlist_sheet(
    members: DataFrame, content: DataFrame, details: DataFrame, albums: DataFrame,
    own_content: DataFrame, listening: DataFrame, genre: DataFrame,
    number_by: Sequence[str] = ("position", "content_uri"), playlist: Sequence[str] = (),
    annotations: Sequence[str] = ANNOTATIONS,
) -> DataFrame:
    """One row per member of one playlist (or of each, when `playlist` names its columns).

    `number_by` must order the members of a playlist without ties: positions repeat where snapshots
    overlap, so the content's uri comes second.
    """
    c = content.select(
        "content_key", F.col("content_name").alias("c_name"),
        F.col("primary_creator_name").alias("c_creator"), F.col("duration_ms").alias("c_ms"),
        "is_resolved",
    )
    d = details.select(
        "content_key", "album_key", F.col("isrc").alias("d_isrc"), "is_explicit", "track_number"
    )
    a = albums.select("album_key", "album_name", "release_date", "album_type")
    own = own_content.select("content_uri", F.col("duration_ms").alias("own_ms"))
    if playlist:
        numbered = split_scan(
            members, list(playlist), list(number_by), F.floor(F.col(number_by[0]) / 100_000),
            row_number="order_number",
        )
    else:
        numbered = ranked(members, [F.asc(x) for x in number_by], "order_number")
    rows = (
        numbered.join(c, "content_key", "left").join(d, "content_key", "left")
        .join(a, "album_key", "left").join(own, "content_uri", "left")
        .join(listening, "content_key", "left").join(genre, "content_key", "left")
    )
    ms = F.coalesce("own_ms", "c_ms")
    year = F.nullif(F.substring("release_date", 1, 4), F.lit("")).cast("int")
    date = lambda name: F.date_format(F.col(name), "yyyy-MM-dd").alias(name)
    return rows.select(
        *playlist, "order_number",
        F.element_at(F.split("content_uri", ":"), 3).alias("track_id"),
        F.coalesce("content_name", "c_name").alias("song"),
        F.coalesce("primary_creator_name", "c_creator").alias("artist"),
        F.col("album_name").alias("album"), year.alias("year"),
        duration_text(ms).alias("duration"), ms.alias("duration_ms"), "genre",
        F.coalesce("plays", F.lit(0)).alias("plays"),
        F.coalesce("qualified_plays", F.lit(0)).alias("qualified_plays"),
        F.coalesce(F.round(F.col("ms_played") / 60000, 1), F.lit(0.0)).alias("minutes"),
        date("first_played"), date("last_played"), F.coalesce("isrc", "d_isrc").alias("isrc"),
        date("added_at"), F.col("is_explicit").alias("explicit"),
        F.col("track_number").alias("track_no"), "album_type", F.col("is_resolved").alias("resolved"),
        *[F.lit("").alias(name) for name in annotations],
    )


def sheet_coverage(sheet: DataFrame, annotations: Sequence[str] = ANNOTATIONS) -> DataFrame:
    """How many rows fill each column; NULL and blank both count as unfilled."""
    columns = [c for c in sheet.columns if c not in annotations]
    filled = lambda c: F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.count_if(filled(c)).alias("populated"),
                   F.count(F.lit(1)).alias("of")) for c in columns]
    )
    rows = sheet.agg(cells.alias("c")).select(F.explode("c").alias("c")).select("c.*")
    return rows.filter("of > 0").withColumn(
        "pct", F.round(F.lit(100.0) * F.col("populated") / F.col("of"), 0)
    )
