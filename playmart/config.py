"""Settings and fixed values shared by the whole package."""

from __future__ import annotations

from dataclasses import dataclass

MS_PER_HOUR = 3_600_000

# --- Fixed values: they decide results, so they are stated as they are. -------------------------

# First day of the calendar dimension and start of every entity's first version.
HISTORY_EPOCH = "2008-10-07"

CONTENT_TYPES = ("track", "episode", "audiobook_chapter")
CATEGORY_OF_TYPE = {"track": "music", "episode": "podcast", "audiobook_chapter": "audiobook"}
CATEGORIES = ("music", "podcast", "audiobook")

# (first hour, name); a daypart runs until the next one starts.
DAYPARTS = (
    (0, "overnight"),
    (5, "morning"),
    (9, "midday"),
    (12, "afternoon"),
    (17, "evening"),
    (22, "night"),
)
DAYPART_NAMES = tuple(name for _, name in DAYPARTS)
WEEKDAY_NAMES = (
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
)

# Prefix of the lower-cased device string -> device family, first match wins.
PLATFORM_PREFIXES = (
    ("windows", "Windows"),
    ("osx", "macOS"),
    ("ios", "iOS"),
    ("android", "Android"),
    ("web_player", "web player"),
    ("webplayer", "web player"),
    ("partner", "connected device"),
    ("sonos", "connected device"),
    ("comcast", "connected device"),
    ("tizen", "connected device"),
    ("cast", "connected device"),
    ("not_applicable", "not recorded"),
    ("unknown", "not recorded"),
)

GENRE_BUCKETS = (
    "hip-hop / rap",
    "pop",
    "rock",
    "alt / indie rock",
    "hard rock / metal",
    "country / americana",
    "folk / singer-songwriter",
    "r&b / soul",
    "electronic / dance",
    "latin",
    "jazz / blues",
    "classical",
    "spoken / comedy",
    "other",
)
OTHER_BUCKET = "other"
UNCLASSIFIED = "unclassified"
UNIDENTIFIED = "(unidentified)"

REDACTED = "<redacted>"
PERSON_FIELDS = (
    "account_id", "birthdate", "display_name", "email", "external_urls", "href", "id",
    "images", "uri",
)
HIDDEN_VALUE_FIELDS = ("platform",)
IDENTIFIER_SUFFIXES = ("_id", "_uri", "_mbid")
IDENTIFIER_FIELDS = ("request_key",)

# Keys of an export record that identify a person's network or device.
EXPORT_PII_KEYS = ("ip_addr", "ip_addr_decrypted", "user_agent", "user_agent_decrypted")

LONG_TAIL_EDGES = (1, 2, 3, 5, 10, 25, 50, 100)

# ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """Thresholds of the reports; the defaults are the published definitions."""

    tag_type: str = "genre"
    qualified_ms: int = 30_000
    qualified_share: float = 0.5
    weekly_after_days: int = 730
    phase_months: int = 6
    phase_threshold_hours: float = 1.0
    phase_min_plays: int = 100
    active_within_days: int = 90
    min_track_plays: int = 10
    one_hit_share: float = 0.8
    one_hit_quiet_months: int = 6
    long_play_hours: int = 2
    millisecond_threshold: int = 100_000_000_000
    other_share_limit: float = 0.15
    profile_overlap_limit: float = 0.05


SETTINGS = Settings()


@dataclass(frozen=True)
class ExtractOptions:
    """What a published extract may contain."""

    profile: str | None = None
    exclude_incognito: bool = True
    include_conn_country: bool = False
    include_platform_family: bool = False
    tag_type: str = "genre"
