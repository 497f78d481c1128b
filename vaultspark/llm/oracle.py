"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

#: crc32 of a number's decimal digits, as DuckDB has no such function: the bytes and eight shifts for each, folded.
CRC32 = (
    "xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(cast({c} as varchar), ''), "
    "lambda s: [(-256 - ascii(s))::bigint, 0, 0, 0, 0, 0, 0, 0, 0]))), "
    "lambda r, x: case when x < 0 then xor(r, -x - 256) when r % 2 = 1 then xor(r // 2, 3988292384) else r // 2 end), 4294967295)")

#: Every beginning written out as the joined ids of its turns; a node's subtree is found through all its ancestors.
TURN_TRIE = f"""
with ids as (
  select conv_id, turn, coalesce(role, '') r,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) id,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) words
  from conversations where conv_id is not null),
turns as (select *, row_number() over (partition by conv_id order by turn nulls first, r, id) pos from ids),
convs as (select distinct conv_id, {CRC32.format(c="conv_id")} % 4 h from turns),
rebuilt as (
  select c.conv_id, 0 part, t.pos, t.id, t.words from convs c join turns t on t.conv_id = c.conv_id - c.conv_id % 20 and t.pos <= c.h
  union all select c.conv_id, 1, t.pos, t.id, t.words from convs c join turns t on t.conv_id = c.conv_id and t.pos > c.h),
places as (select *, row_number() over (partition by conv_id order by part, pos) d from rebuilt),
marks as (
  select conv_id, cast(d as bigint) depth, words,
    string_agg(id, '') over (partition by conv_id order by d rows between unbounded preceding and current row) node from places
  union all select conv_id, 0, 0, '' from convs),
ends as (select conv_id, last(node order by depth) node from marks group by 1),
nodes as (select node, any_value(depth) depth, any_value(words) words, min(conv_id) conv_id, count(*) n_convs from marks group by 1),
ended as (select node, string_agg(cast(conv_id as varchar), ',' order by conv_id) ids from ends group by 1),
linked as (
  select n.*, p.conv_id parent_conv_id, p.node parent
  from nodes n left join nodes p on n.depth > 0 and p.node = left(n.node, 32 * (n.depth - 1)::int)),
kids as (select parent, count(*) n_children from linked where depth > 0 group by 1),
below as (
  select left(l.node, 32 * a.up::int) node, sum(case when k.parent is null then 1 else 0 end) n_leaves, sum((l.n_convs - 1) * l.words) saved
  from linked l left join kids k on k.parent = l.node, lateral (select unnest(range(0, l.depth + 1)) up) a group by 1)
select l.conv_id, l.depth, l.parent_conv_id, cast(l.n_convs as bigint) n_convs, cast(coalesce(k.n_children, 0) as bigint) n_children,
  cast(b.n_leaves as bigint) n_leaves, cast(b.saved as bigint) saved_tokens, sha256(coalesce(e.ids, '')) ends_sha256
from linked l join below b on b.node = l.node left join kids k on k.parent = l.node left join ended e on e.node = l.node"""

#: Payloads of 1000 bytes or more are equal by their digest; all but the one with the largest id revisit it.
WARC = """
with d as (
  select page_id, cast(strlen(coalesce(html, '')) as bigint) payload_bytes, sha1(coalesce(html, '')) payload_digest from pages),
m as (
  select *, max(page_id) over (partition by payload_digest) top from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id < top then 'revisit' else 'response' end record_type,
  case when payload_bytes >= 1000 and page_id < top then top end refers_to
from m"""
