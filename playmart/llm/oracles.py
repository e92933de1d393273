"""DuckDB SQL that queries of this package must agree with, where it takes more than a few lines."""

from __future__ import annotations

CRC_TABLE = """
    crc_steps as (
        select n, list_reduce(range(8), lambda c, i: case when c % 2 = 1 then xor(3988292384, c >> 1) else c >> 1 end, n) as c
        from (select unnest(range(256)) as n)
    ), crc_table as (select list(c order by n) as t from crc_steps)"""


def crc32(bytes_list: str, table: str) -> str:
    """CRC-32 of a list of byte values, by a byte-wise table."""
    return f"xor(4294967295, list_reduce({bytes_list}, lambda c, b: xor({table}[(xor(c, b) & 255) + 1], c >> 8), 4294967295))"

PREFIX_TRIE = f"""
    with {CRC_TABLE}, told as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
               row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
        from conversations where conv_id is not null
    ), own as (
        select conv_id, list({{'role': role, 'text': text}} order by pos) as turns from told group by conv_id
    ), sized as (
        select conv_id, turns, conv_id - conv_id % 100 as root,
               {crc32("list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(unicode(x) as bigint))", "t")} % 6 as h
        from own, crc_table
    ), rebuilt as (
        select s.conv_id, coalesce(r.turns[1:s.h], []) || s.turns[s.h + 1:] as turns
        from sized s left join own r on s.root = r.conv_id
    ), prefixes as (
        select conv_id, d as depth, len(turns) = d as ends, turns[1:d] as prefix, turns[1:d - 1] as shorter
        from (select conv_id, turns, unnest(range(len(turns) + 1)) as d from rebuilt)
    ), nodes as (
        select depth, prefix, any_value(shorter) as shorter, min(conv_id) as conv_id, count(*) as n_convs,
               sha256(coalesce(string_agg(conv_id, ',' order by conv_id) filter (where ends), '')) as ends_sha256,
               case when depth = 0 then 0 else (count(*) - 1) * length(prefix[depth]['text']) end as saved
        from prefixes group by depth, prefix
    ), fans as (
        select n.*, p.conv_id as parent_conv_id, (select count(*) from nodes c where c.depth = n.depth + 1 and c.shorter = n.prefix) as n_children
        from nodes n left join nodes p on p.depth = n.depth - 1 and p.prefix = n.shorter
    ), members as (
        select n.conv_id, n.depth, m.conv_id as below, m.depth as below_depth, m.n_children, m.saved
        from fans n join fans m on m.depth >= n.depth and m.prefix[1:n.depth] = n.prefix
    )
    select n.conv_id, cast(n.depth as bigint) as depth, n.parent_conv_id, n.n_convs, n.n_children,
           cast(sum(cast(m.n_children = 0 as bigint)) as bigint) as n_leaves, cast(sum(m.saved) as bigint) as saved_tokens, n.ends_sha256
    from fans n join members m on m.conv_id = n.conv_id and m.depth = n.depth
    group by n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, n.ends_sha256"""

_RUN_BYTES = """flatten(list_transform(string_split(concat(coalesce(cast(doc_id as varchar), ''), ':', run), ''), lambda x:
            case when unicode(x) < 128 then [cast(unicode(x) as bigint)]
                 else [cast(195 as bigint), cast(unicode(x) - 64 as bigint)] end))"""

SPELLING = f"""
    with recursive {CRC_TABLE}, runs as (
        select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
        from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as run from documents where text is not null)
        group by all
    ), told as (
        select run, n, {crc32(_RUN_BYTES, "t")} as h from runs, crc_table
    ), words as (
        select case when h % 199 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word, sum(n) as n
        from told group by 1 having length(word) >= 6 and sum(n) >= 5
    ), places as (
        select word, n, i, word[:i] || word[i + 2:] as rest from (select word, n, unnest(range(length(word))) as i from words)
    ), near as (
        select distinct a.word, b.word as other, b.n as other_n
        from places a join places b on a.i = b.i and a.rest = b.rest and a.word != b.word and length(a.word) = length(b.word)
        union select p.word, w.word, w.n from places p join words w on p.rest = w.word
        union select w.word, p.word, p.n from places p join words w on p.rest = w.word
    ), best as (
        select word, count(*) as n_near, max(other_n) as top, arg_min(other, (-other_n, other)) as other from near group by word
    ), forms as (
        select w.word, w.n, coalesce(n_near, 0) as n_near, case when top >= 5 * w.n then other end as form,
               case when top >= 5 * w.n then top end as form_n
        from words w left join best b on w.word = b.word
    ), chain as (
        select word, word as root, form as next from forms
        union all select c.word, f.word, f.form from chain c join forms f on c.next = f.word
    )
    select f.word, cast(f.n as bigint) as n, cast(n_near as bigint) as n_near, f.form, cast(f.form_n as bigint) as form_n, c.root
    from forms f join chain c on c.word = f.word and c.next is null"""
