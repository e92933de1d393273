"""Explicit schemas of the landed JSON documents. Field names are fixed values of the feeds.

Parsing with a StructType lets Catalyst prune nested fields that a query never touches.
"""

from __future__ import annotations

ARTIST_REF = "struct<id:string,uri:string,name:string>"

ALBUM = (
    "struct<id:string,uri:string,name:string,album_type:string,release_date:string,"
    f"release_date_precision:string,total_tracks:int,artists:array<{ARTIST_REF}>>"
)

TRACK_FIELDS = (
    "uri:string,id:string,type:string,name:string,duration_ms:int,explicit:boolean,"
    "disc_number:int,track_number:int,is_local:boolean,external_ids:struct<isrc:string>,"
    f"album:{ALBUM},artists:array<{ARTIST_REF}>"
)
TRACK = f"struct<{TRACK_FIELDS}>"

RECENTLY_PLAYED = (
    f"struct<items:array<struct<played_at:timestamp,track:{TRACK},"
    "context:struct<type:string,uri:string>>>>"
)

ARTIST = "struct<id:string,uri:string,name:string>"
ME = "struct<id:string,display_name:string,country:string,product:string>"

PLAYLIST_PAGE = (
    "struct<items:array<struct<id:string,uri:string,name:string,description:string,"
    "is_owned_by_profile:boolean,collaborative:boolean,public:boolean,snapshot_id:string,"
    "items:struct<total:int>,tracks:struct<total:int>>>>"
)

# An entry carries its track under `item` or, in older pages, under `track`.
PLAYLIST_ITEM_PAGE = (
    "struct<href:string,offset:int,items:array<struct<added_at:string,"
    f"item:{TRACK},track:{TRACK}>>>"
)

EXPORT_RECORD = (
    "struct<ts:timestamp,ms_played:bigint,spotify_track_uri:string,spotify_episode_uri:string,"
    "audiobook_chapter_uri:string,master_metadata_track_name:string,"
    "master_metadata_album_album_name:string,master_metadata_album_artist_name:string,"
    "episode_name:string,episode_show_name:string,audiobook_title:string,"
    "audiobook_chapter_title:string,reason_start:string,reason_end:string,skipped:boolean,"
    "shuffle:boolean,offline:boolean,incognito_mode:boolean,offline_timestamp:bigint,"
    "platform:string,conn_country:string>"
)

ISRC_LOOKUP = (
    "struct<recordings:array<struct<`artist-credit`:array<struct<artist:struct<id:string>>>>>>"
)
TAG = "struct<name:string,count:int>"
EXTERNAL_ARTIST = f"struct<name:string,genres:array<{TAG}>,tags:array<{TAG}>>"

RAW_RESPONSE = (
    "id bigint, feed string, profile_slug string, source_file string, ingested_at timestamp, "
    "payload string"
)
RAW_EXTERNAL = (
    "id bigint, source string, feed string, request_key string, ingested_at timestamp, "
    "payload string"
)
RAW_EXPORT = (
    "profile_slug string, source_file string, record_index bigint, ingested_at timestamp, "
    "payload string"
)
PROFILE_REGISTRY = "profile_slug string, household_role string, home_timezone string"
GENRE_BUCKET = "bucket_order int, bucket_name string"
GENRE_BUCKET_MAP = "genre_name string, bucket_name string"
