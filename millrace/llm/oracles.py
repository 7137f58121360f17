"""DuckDB statements of the operators that take more than a few lines of SQL."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit; 3988292384 is the reversed polynomial."""
    step = "lambda x, y: xor(x >> 1, 3988292384 * (x & 1))"
    letters = f"list_transform(range(1, strlen({text}) + 1), lambda i: ascii({text}[i])::bigint)"
    byte = f"lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], {step})"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::bigint, {letters}), {byte}))"


# Merkle manifest: all levels of every tree as lists, then one step per row and level.


def _leaf(n_chars: str) -> str:
    fields = [f"coalesce(strlen({x}::varchar) || ':' || {x}::varchar, '-')" for x in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(fields)})"


MANIFEST = f"""
    with recursive leaves as (
        select doc_id, lang, {_leaf('n_chars')} as leaf,
               case when {crc32('(doc_id::varchar)')} % 7 = 0 then {_leaf('(n_chars + 1)')} end as tampered
        from documents),
    places as (
        select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos from leaves),
    levels (lang, level, nodes) as (
        select lang, 0, list(leaf order by pos) from places group by lang
        union all
        select lang, level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
        from levels where len(nodes) > 1),
    subroots as (
        select lang, level as height, nodes[1] as subroot, row_number() over (order by lang nulls first) - 1 as pos
        from levels where len(nodes) = 1),
    tops (level, nodes) as (
        select 0, list(subroot order by pos) from subroots
        union all
        select level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
        from tops where len(nodes) > 1),
    steps as (
        select p.doc_id, p.leaf, l.level, p.pos >> l.level as own, l.nodes
        from places p join levels l on p.lang is not distinct from l.lang where len(l.nodes) > 1
        union all
        select p.doc_id, p.leaf, s.height + t.level, s.pos >> t.level, t.nodes
        from places p join subroots s on p.lang is not distinct from s.lang, tops t where len(t.nodes) > 1),
    sides as (
        select doc_id, leaf, level, case when own % 2 = 1 then nodes[own] else '' end as before,
               case when own % 2 = 0 then coalesce(nodes[own + 2], '') else '' end as behind
        from steps),
    folds (doc_id, leaf, level, node) as (
        select doc_id, leaf, 0, coalesce(tampered, leaf) from places
        union all
        select f.doc_id, f.leaf, f.level + 1, sha256(s.before || f.node || s.behind)
        from folds f join sides s on s.doc_id is not distinct from f.doc_id and s.leaf = f.leaf and s.level = f.level),
    proofs as (select doc_id, leaf, string_agg(before || behind, '' order by level) as proof from sides group by doc_id, leaf),
    root as (select nodes[1] as root from tops where len(nodes) = 1)
    select p.doc_id, p.leaf, s.subroot, r.root, sha256(coalesce(q.proof, '')) as proof_sha256, f.node as folded_root, f.node = r.root as verified
    from places p join subroots s on p.lang is not distinct from s.lang cross join root r
    left join proofs q on q.doc_id is not distinct from p.doc_id and q.leaf = p.leaf
    join (select doc_id, leaf, arg_max(node, level) as node from folds group by doc_id, leaf) f
      on f.doc_id is not distinct from p.doc_id and f.leaf = p.leaf"""


# Conversation repair: costs and edits of the rest, row by row from the end, for each of the four states.


def _edit(letter: str, cost: str, rest: str) -> str:
    return f"{{'cost': {rest}.cost + {cost}, 'audit': '{letter}' || {rest}.audit}}"


def _least(*options: str) -> str:
    return f"list_sort(list_filter([{', '.join(options)}], lambda o: o is not null))[1]"


def _delete(rest: str) -> str:
    return _edit("D", "4", rest)


def _rerole(rest: str) -> str:
    return f"if(not gone, {_edit('R', '3 + 3 * truncated::int', rest)}, null)"


def _keep(initial: str, rest: str) -> str:
    return f"if(not gone and initial = '{initial}', {_edit('K', '3 * truncated::int', rest)}, null)"


def _insert(rest: str) -> str:
    return _edit("I", "3", rest)


def _end(cost: int, audit: str) -> str:
    return f"{{'cost': {cost}, 'audit': '{audit}'}}"


REPAIR = f"""
    with recursive coded as (
        select *, {crc32('key')} % 20 as code
        from (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                     coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations)),
    damaged as (
        select conv_id, turn, if(code = 4, 'user', role) as role,
               case code when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
               unnest(range(case code when 0 then 0 when 3 then 2 else 1 end)) as copy
        from coded),
    ordered as (
        select *, role[1] as initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as said,
               row_number() over (partition by conv_id order by turn nulls first, role, text) as i
        from damaged),
    numbered as (select *, row_number() over (partition by conv_id, role, text order by i) as nth from ordered),
    faults as (
        select *, said = '' as blank, said <> '' and nth > 1 as duplicate, said = '' or nth > 1 as gone,
               said <> '' and nth = 1 and right(said, 1) not in ('.', '!', '?') as truncated,
               lag(initial) over (partition by conv_id order by i) as before
        from numbered),
    counts as (
        select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
               count_if(blank) as blank, count_if(duplicate) as duplicate, count_if(truncated) as truncated,
               count_if(i > 1 and before || initial not in ('su', 'ua', 'au')) as illegal
        from faults group by conv_id),
    solved (conv_id, i, s0, s1, su, sa) as (
        select conv_id, n + 1, {_end(0,'')}, {_end(6,'II')}, {_end(3,'I')}, {_end(0,'')} from counts
        union all
        select conv_id, i, {_least('b0', _insert('cu'))}, {_least('b1', _insert('cu'))}, cu, {_least('ba', _insert('bu'))}
        from (select *, {_least('bu', _insert('ba'))} as cu
              from (select s.conv_id, f.i, {_least(_delete('s0'), _rerole('su'), _keep('s','s1'), _keep('u','su'))} as b0,
                           {_least(_delete('s1'), _rerole('su'), _keep('u','su'))} as b1, {_least(_delete('su'), _rerole('sa'), _keep('a','sa'))} as bu,
                           {_least(_delete('sa'), _rerole('su'), _keep('u','su'))} as ba
                    from solved s join faults f on f.conv_id is not distinct from s.conv_id and f.i = s.i - 1))),
    audits as (select conv_id, s0.cost as cost, s0.audit as audit from solved where i = 1),
    applied (conv_id, audit, j, i, said, lines) as (
        select conv_id, audit, 0, 0::bigint, '', []::varchar[] from audits
        union all
        select a.conv_id, audit, j + 1, if(letter = 'I', a.i, a.i + 1),
               case letter when 'D' then a.said when 'K' then f.initial else given[1] end,
               case letter when 'D' then lines when 'K' then list_append(lines, f.role || ':' || f.text)
                           when 'R' then list_append(lines, given || ':' || f.text) else list_append(lines, given || ':') end
        from (select *, audit[j + 1] as letter, if(said = 'u', 'assistant', 'user') as given from applied where j < length(audit)) a
        left join faults f on f.conv_id is not distinct from a.conv_id and f.i = a.i + 1),
    repaired as (select conv_id, sha256(array_to_string(lines, chr(10))) as digest from applied where j = length(audit))
    select c.conv_id, coalesce(n.gaps, 0)::bigint as gaps, coalesce(n.blank, 0)::bigint as blank, coalesce(n.duplicate, 0)::bigint as duplicate,
           coalesce(n.truncated, 0)::bigint as truncated, coalesce(n.illegal, 0)::bigint as illegal, coalesce(a.cost, 0)::bigint as cost,
           coalesce(a.audit, '') as audit, coalesce(r.digest, sha256('')) as repaired_sha256
    from (select distinct conv_id from conversations) c
    left join counts n on n.conv_id is not distinct from c.conv_id
    left join audits a on a.conv_id is not distinct from c.conv_id
    left join repaired r on r.conv_id is not distinct from c.conv_id"""
