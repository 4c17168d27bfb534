"""DuckDB SQL for the whole results of the later operators, as text.

Plain forms, for comparison only: trees are unrolled to ``LEVELS`` levels, similar pairs come
from a join on single shingles.
"""

from __future__ import annotations

LEVELS = 6  # 16 ** 6 leaves of one source

#: the standard's reflected polynomial; SQL has no crc32 of its own
_POLYNOMIAL = 0xEDB88320
_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def crc32(text: str) -> str:
    """The unsigned crc32 of an ASCII string expression: each byte is taken in at the first of
    its eight shifts."""
    step = f"case when xor(a, b) & 1 = 1 then xor(xor(a, b) >> 1, {_POLYNOMIAL}::bigint) else xor(a, b) >> 1 end"
    byte = f"[ascii(substr({text}, i, 1))::bigint, 0, 0, 0, 0, 0, 0, 0]"
    steps = f"flatten(list_transform(generate_series(1, length({text})), lambda i: {byte}))"
    return f"xor(list_reduce({steps}, lambda a, b: {step}, 4294967295::bigint), 4294967295::bigint)"


def trie() -> str:
    turn = "strlen(role) || ':' || role || text"
    return f"""
with recursive turns as (
  select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, md5({turn})) as pos
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)
), convs as (
  select conv_id, {crc32("conv_id::varchar")} % 6 as h from (select distinct conv_id from turns)
), rebuilt as (
  select c.conv_id, 0 as part, t.pos, t.role, t.text from convs c join turns t on t.conv_id = c.conv_id - c.conv_id % 100 and t.pos <= c.h
  union all
  select c.conv_id, 1, t.pos, t.role, t.text from convs c join turns t on t.conv_id = c.conv_id and t.pos > c.h
), deep as (
  select conv_id, row_number() over (partition by conv_id order by part, pos) as depth, md5({turn}) as digest, length(text) as chars
  from rebuilt
), prefix as (
  select conv_id, depth, chars, md5(string_agg(digest, '') over (partition by conv_id order by depth)) as key from deep
  union all
  select conv_id, 0, 0, '' from convs
), placed as (
  select *, lag(key) over (partition by conv_id order by depth) as up, max(depth) over (partition by conv_id) as last from prefix
), nodes as (
  select depth, key, any_value(up) as up, min(conv_id) as conv_id, count(*) as n_convs, max(chars) as chars,
         coalesce(string_agg(case when depth = last then conv_id::varchar end, ',' order by conv_id), '') as ends
  from placed group by depth, key
), children as (select depth - 1 as depth, up as key, count(*) as n from nodes where depth > 0 group by all
), valued as (
  select n.*, coalesce(c.n, 0) as n_children from nodes n left join children c on c.depth = n.depth and c.key = n.key
), totals as (
  select a.depth, a.key, sum((v.n_children = 0)::bigint) as n_leaves, sum((v.n_convs - 1) * v.chars) as saved
  from valued v join prefix a on a.conv_id = v.conv_id and a.depth <= v.depth group by all
)
select v.conv_id, v.depth::bigint as depth, p.conv_id as parent_conv_id, v.n_convs::bigint as n_convs, v.n_children::bigint as n_children,
       t.n_leaves::bigint as n_leaves, t.saved::bigint as saved_tokens, sha256(v.ends) as ends_sha256
from valued v join totals t on t.depth = v.depth and t.key = v.key
left join nodes p on p.depth = v.depth - 1 and p.key = v.up
"""


def minhash(percent: int = 80) -> str:
    """Sets of two-word shingles."""
    return f"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\\x20\\x09-\\x0D]+') as w from documents
), sets as (
  select doc_id, case when len(w) < 2 then w
    else list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) end as s from words
), items as (select doc_id, len(s) as n, unnest(s) as e from sets
), pairs as (
  select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as common
  from items a join items b on b.e = a.e and b.doc_id > a.doc_id
    and 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) group by a.doc_id, b.doc_id
), links as (
  select a, b from pairs where 100 * common >= {percent} * (na + nb - common)
  union all select b, a from pairs where 100 * common >= {percent} * (na + nb - common)
), reach as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b
), least_of as (select a, min(b) as b from reach group by a)
select s.doc_id, len(s.s)::bigint as n_shingles, least(s.doc_id, coalesce(l.b, s.doc_id)) as component_id,
       s.doc_id = least(s.doc_id, coalesce(l.b, s.doc_id)) as kept
from sets s left join least_of l on l.a = s.doc_id
"""


def _tree(name: str, leaves: str, fold: str) -> list[str]:
    """Levels of a tree over ``leaves`` (g, idx, h), siblings, and ``fold`` (row, g, idx, acc,
    seen) carried up to the top."""
    out = []
    for k in range(LEVELS):
        source = f"select g, idx, h from {leaves}" if not k else (
            f"select g, idx // 16 as idx, sha256(string_agg(h, '' order by idx)) as h from {name}{k - 1} where n > 1 group by g, idx // 16"
        )
        out.append(f"{name}{k} as (select *, count(*) over (partition by g) as n from ({source}))")
        run = "partition by g, idx // 16 order by idx rows between"
        out.append(
            f"{name}s{k} as (select g, idx, coalesce(string_agg(h, '') over ({run} unbounded preceding and 1 preceding), '') as l,"
            f" coalesce(string_agg(h, '') over ({run} 1 following and unbounded following), '') as r from {name}{k} where n > 1)"
        )
        below = fold if not k else f"{name}f{k - 1}"
        out.append(
            f"{name}f{k} as (select f.rid, f.g, f.idx // 16 as idx, case when s.g is null then f.acc else sha256(s.l || f.acc || s.r) end as acc,"
            f" f.seen || coalesce(s.l || s.r, '') as seen from {below} f left join {name}s{k} s on s.g = f.g and s.idx = f.idx)"
        )
    out.append(f"{name}top as (" + " union all ".join(f"select g, h from {name}{k} where n = 1" for k in range(LEVELS)) + ")")
    return out


def merkle() -> str:
    def encoded(x: str) -> str:
        return f"case when {x} is null then '-' else strlen({x}::varchar) || ':' || {x}::varchar end"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(encoded(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    tampered = f"case when {crc32('doc_id::varchar')} % 5 = 0 then {leaf(f'translate(text, {_LETTERS})')} end"
    parts = [
        f"leaves as (select row_number() over () as rid, coalesce('+' || source, '!') as g, doc_id, {leaf('text')} as h, {tampered} as other from documents)",
        "placed as (select *, row_number() over (partition by g order by doc_id nulls first, h, other) - 1 as idx from leaves)",
        "start as (select rid, g, idx, coalesce(other, h) as acc, '' as seen from placed)",
        *_tree("a", "placed", "start"),
        "tops as (select 0 as g, g as name, row_number() over (order by g) - 1 as idx, h from atop)",
        f"again as (select f.rid, 0 as g, t.idx, f.acc, f.seen from af{LEVELS - 1} f join tops t on t.name = f.g)",
        *_tree("b", "tops", "again"),
    ]
    return f"""
with {", ".join(parts)}
select p.doc_id, p.h as leaf, t.h as subroot, r.h as root, sha256(f.seen) as proof_sha256, f.acc as folded_root, f.acc = r.h as verified
from placed p join bf{LEVELS - 1} f on f.rid = p.rid join atop t on t.g = p.g cross join btop r
"""
