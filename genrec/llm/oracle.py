"""DuckDB SQL of the queries of this subpackage that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII string expression."""
    byte = ("list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), "
            "lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)")
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), lambda a, b: {byte}), 4294967295)"


def _trie() -> str:
    digest = "substring(sha256(concat(length(role), ':', role, ':', text)), 1, 32)"
    return f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
n as (select conv_id, {digest} as tid, len(regexp_extract_all(text, '{WORD}')) as w,
        row_number() over (partition by conv_id order by turn nulls first, {digest}) as pos from t),
c as (select distinct conv_id, {crc32('conv_id::varchar')} % 4 as h, conv_id - conv_id % 20 as base from t),
r as (select c.conv_id, 0 as part, n.pos, n.tid, n.w from c join n on n.conv_id = c.base and n.pos <= c.h
      union all select c.conv_id, 1, n.pos, n.tid, n.w from c join n on n.conv_id = c.conv_id and n.pos > c.h),
p as (select c.conv_id, coalesce(l.path, []) as path, coalesce(l.ws, []) as ws from c left join (
        select conv_id, list(tid order by part, pos) as path, list(w order by part, pos) as ws from r group by conv_id) l
      on l.conv_id = c.conv_id),
m as (select conv_id, len(path) as n, path[1:d] as pre, d, ws[d] as w
      from (select *, unnest(generate_series(0, len(path))) as d from p)),
nodes as (select pre, d, min(conv_id) as conv_id, count(*) as n_convs, coalesce(any_value(w), 0) as w,
        sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = d), '')) as ends_sha256
      from m group by pre, d),
kids as (select pre[1:d - 1] as pre, count(*) as n_children from nodes where d > 0 group by all),
x as (select nodes.*, coalesce(k.n_children, 0) as n_children from nodes left join kids k on k.pre = nodes.pre),
up as (select u.w, u.n_convs, u.n_children, u.pre[1:k] as pre from (
        select *, unnest(generate_series(0, d)) as k from x) u),
sums as (select pre, count(*) filter (n_children = 0) as n_leaves, sum((n_convs - 1) * w) as saved_tokens from up group by pre)
select x.conv_id, x.d as depth, q.conv_id as parent_conv_id, x.n_convs, x.n_children, s.n_leaves,
  s.saved_tokens::bigint as saved_tokens, x.ends_sha256
from x join sums s on s.pre = x.pre left join x q on x.d > 0 and q.pre = x.pre[1:x.d - 1]"""


def _repair() -> str:
    """The cheapest repair by a recursion over rows: for each state the least (cost, audit, repaired text)."""
    none = "{'c': 1000000000::bigint, 'a': '', 'o': ''}"

    def step(state: str, cost: str, letter: str, line: str = "''") -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {state}.o || {line}}}"

    def when(test: str, value: str) -> str:
        return f"case when {test} then {value} else {none} end"

    own, user, assistant = "chr(10) || r.role || ':' || r.text", "chr(10) || 'user:' || r.text", "chr(10) || 'assistant:' || r.text"
    key = "concat(coalesce(conv_id::varchar, ' '), ':', coalesce(turn::varchar, ' '))"
    digest = "substring(sha256(concat(length(role), ':', role, ':', text)), 1, 32)"
    to_user = [x for s in "zsa" for x in (
        when("r.code in ('u', 'U')", step(f"i{s}", "r.late", "K", own)), when("r.code <> 'x'", step(f"i{s}", "2 + r.late", "R", user)))]
    return rf"""
with recursive d0 as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        {crc32(key)} % 20 as draw from conversations),
d1 as (select conv_id, turn, case when draw = 4 then 'user' else role end as role,
        case when draw = 1 then '' when draw = 2 then translate(text, '.!?', '') else text end as text,
        unnest(generate_series(1, case when draw = 3 then 2 else 1 end)) as copy from d0 where draw <> 0),
d2 as (select conv_id, turn, role, text, {digest} as tid, left(role, 1) as initial, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) as fin,
        row_number() over (partition by conv_id order by turn nulls first, {digest}) as pos from d1),
d3 as (select *, case when fin = '' then 'blank' when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
        when fin not in ('.', '!', '?') then 'truncated' else '' end as fault,
        lag(initial) over (partition by conv_id order by pos) as before from d2),
r as (select *, case when fault in ('blank', 'duplicate') then 'x' when initial in ('s', 'u', 'a') then initial else 'o' end as code,
        case when fault = 'truncated' then 1 else 0 end as late from d3),
w as (select conv_id, 0::bigint as pos, {{'c': 0::bigint, 'a': '', 'o': ''}} as z, {none} as s, {none} as u, {none} as a from r group by conv_id
  union all
  select conv_id, pos, {step("iz", "3", "D")}, least({step("is_", "3", "D")}, {when("r_code = 's'", step("iz", "r_late", "K", "r_own"))}),
    least({step("iu", "3", "D")}, {", ".join(to_user).replace("is.", "is_.")}),
    least({step("ia", "3", "D")}, {when("r.code = 'a'", step("iu", "r.late", "K", own))}, {when("r.code <> 'x'", step("iu", "2 + r.late", "R", assistant))})
  from (select r.conv_id, r.pos, r.role, r.text, r.code, r.late, r.code as r_code, r.late as r_late, {own} as r_own, w.z as iz, w.s as is_, w.iu as iu,
          least(w.a, {step("w.iu", "2", "I", "chr(10) || 'assistant:'")}) as ia
        from (select *, least(u, {step("z", "2", "I", "chr(10) || 'user:'")}, {step("s", "2", "I", "chr(10) || 'user:'")},
                {step("a", "2", "I", "chr(10) || 'user:'")}) as iu from w) w
        join r on r.conv_id is not distinct from w.conv_id and r.pos = w.pos + 1) r),
e as (select conv_id, least(z, a, {step("least(u, " + step("s", "2", "I", "chr(10) || 'user:'") + ")", "2", "I", "chr(10) || 'assistant:'")}) as best
      from w qualify pos = max(pos) over (partition by conv_id)),
g as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
        count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
        count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal from r group by conv_id)
select c.conv_id, coalesce(g.gaps, 0) as gaps, coalesce(g.blank, 0) as blank, coalesce(g.duplicate, 0) as duplicate,
  coalesce(g.truncated, 0) as truncated, coalesce(g.illegal, 0) as illegal, coalesce(e.best.c, 0) as cost, coalesce(e.best.a, '') as audit,
  sha256(coalesce(substring(e.best.o, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join g on g.conv_id is not distinct from c.conv_id
  left join e on e.conv_id is not distinct from c.conv_id"""


def oracle_sql() -> dict[str, str]:
    return {"op11_structure_repair": _repair(), "op13_prefix_trie": _trie()}
