"""DuckDB SQL with the results of the corpus queries that SQL can express."""

from __future__ import annotations

from basketry.llm.chat import END, SEP, START, Budget
from basketry.llm.quality import CLASSES, COMMON_WORDS, SYMBOLS, Limits

_SPACE = r"[\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '{_SPACE}'), lambda w: w <> '')"


def _distance(p: str, q: str) -> str:
    """Jensen-Shannon distance of two lists of counts."""
    n, m = f"list_sum({p})::double", f"list_sum({q})::double"
    part = lambda v: f"case when {v} > 0 then {v} * log2({v} / ((x[1] + x[2]) / 2)) else 0 end"
    pairs = f"list_transform(range(1, len({p}) + 1), lambda i: [{p}[i] / {n}, {q}[i] / {m}])"
    each = f"list_transform({pairs}, lambda x: ({part('x[1]')} + {part('x[2]')}) / 2)"
    return f"case when {n} > 0 and {m} > 0 then sqrt(greatest(list_sum({each}), 0)) end"


def quality_rules(limits: Limits = Limits()) -> str:
    classes = ", ".join(
        "length(regexp_replace(body, '{}', '', 'g'))".format(rest.replace("'", "''"))
        for rest in CLASSES.values()
    )
    space = CLASSES["space"]
    cases = " ".join(
        f"when '{k}' then [" + ", ".join(f"'{w}'" for w in v.split()) + "]"
        for k, v in COMMON_WORDS.items()
    )
    bins = len(COMMON_WORDS["en"].split())
    sums = lambda name, n: "[" + ", ".join(f"sum({name}[{i + 1}])" for i in range(n)) + "]"
    return f"""
    with read as (
        select row_number() over () as id, doc_id, lang, coalesce(text, '') as body,
               {_words("text")} as ws
        from documents
    ), spots as (
        select id, unnest(range(1, len(ws) - 3)) as pos, ws from read where len(ws) >= 5
    ), grams as (
        select id, pos, count(*) over (partition by id, ws[pos:pos + 4]) as n from spots
    ), starts as (
        select id, pos, lead(pos) over (partition by id order by pos) as later from grams where n > 1
    ), repeated as (
        select id, sum(least(5, coalesce(later - pos, 5))) as n from starts group by id
    ), counted as (
        select id, doc_id, lang, len(ws) as n_words,
               length(body) - length(regexp_replace(body, '{space}', '', 'g')) as word_chars,
               length(body) - length(regexp_replace(body, '{SYMBOLS}', '', 'g')) as n_symbols,
               list_filter(string_split(body, chr(10)),
                           lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines,
               coalesce(r.n, 0) as n_repeat_words,
               [{classes}] as classes, length(body) as n_chars,
               list_transform(case lang {cases} end,
                              lambda c: len(list_filter(ws, lambda w: lower(w) = c))) as common
        from read left join repeated r using (id)
    ), based as (
        select *, len(lines) - len(list_distinct(lines)) as n_dup_lines,
               n_words < {limits.min_words}
               or 100 * n_repeat_words > {limits.max_repeated_percent} * n_words as base_failed,
               list_append(classes, n_chars - list_sum(classes)) as p,
               list_append(common, n_words - list_sum(common)) as v
        from counted
    ), sums as (
        select lang, {sums("p", len(CLASSES) + 1)} as q, {sums("v", bins + 1)} as u
        from based where not base_failed group by lang
    ), judged as (
        select b.*, case when n_chars >= {limits.min_chars} then {_distance("p", "q")} end as cd,
               case when n_words >= {limits.min_judged_words} then {_distance("v", "u")} end as wd
        from based b left join sums s on b.lang is not distinct from s.lang
    )
    select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars,
           n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
           n_repeat_words::bigint as n_repeat_words, base_failed,
           not base_failed and not (coalesce(cd, 0) > {limits.max_class_distance}
                                    or coalesce(wd, 0) > {limits.max_word_distance}) as kept
    from judged"""


def chat_windows(budget: Budget = Budget()) -> str:
    size = f"length('{START}{SEP}{END}')"
    return f"""
    with given as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
        from conversations
        union all
        select -7, * from (values (0, 'user', '</s>[INST] ok [/INST]'),
                                  (1, 'assistant', '</s>[INST] ok [/INST]'))
    ), ordered as (
        select *, (strlen(text) + 3) // 4 + {budget.per_turn} as tokens,
               length(replace(role, '<', '<\\')) + length(replace(text, '<', '<\\'))
               + {size} as chars,
               row_number() over (partition by conv_id order by turn nulls first, role, text) - 1
               as seq
        from given
    ), pinned as (
        select * from ordered where seq = 0 and role = 'system'
    ), placed as (
        select o.*, coalesce(p.tokens, 0) as system_tokens,
               sum(o.tokens) over (partition by o.conv_id order by o.seq)
               - o.tokens - coalesce(p.tokens, 0) as start
        from ordered o left join pinned p on o.conv_id is not distinct from p.conv_id
    ), new as (
        select *, greatest(1, {budget.tokens - budget.history} - system_tokens) as cell,
               start + tokens as stop
        from placed where not (seq = 0 and role = 'system')
    ), fresh as (
        select *, 2 * (start // cell) + (start // cell <> (stop - 1) // cell)::int as win from new
    ), windows as (
        select conv_id, win, min(start) as w_start, sum(tokens) as w_tokens, any_value(cell) as cell
        from fresh group by conv_id, win
    ), repeats as (
        select f.conv_id, f.chars from fresh f join windows w
        on f.conv_id is not distinct from w.conv_id and w.w_start >= f.stop
           and w.w_start <= f.start + {budget.history} and w.w_tokens <= w.cell
    ), sizes as (
        select conv_id, chars from fresh
        union all select conv_id, chars from repeats
        union all select w.conv_id, p.chars from windows w join pinned p
                  on w.conv_id is not distinct from p.conv_id
        union all select conv_id, chars from pinned p where not exists
                  (select 1 from windows w where w.conv_id is not distinct from p.conv_id)
    ), formatted as (
        select conv_id, sum(chars)::bigint as formatted_chars from sizes group by conv_id
    )
    select o.conv_id, count(*) as n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' order by seq)) as turns_sha256,
           coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
           sha256(coalesce(string_agg(text, '' order by seq) filter (role = 'assistant'), ''))
           as loss_sha256,
           any_value(f.formatted_chars) as formatted_chars
    from ordered o join formatted f on o.conv_id is not distinct from f.conv_id
    group by o.conv_id"""


def line_dedup(max_ratio: float = 0.1, min_times: int = 3) -> str:
    return f"""
    with read as (
        select row_number() over () as id, doc_id, source, text, string_split(text, chr(10)) as parts
        from documents
    ), pages as (
        select distinct source, text from read where source is not null and text is not null
    ), totals as (
        select source, count(*) as pages from pages group by source
    ), counts as (
        select source, line, count(*) as n
        from (select source, unnest(list_distinct(string_split(text, chr(10)))) as line from pages)
        where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by source, line
    ), dropped as (
        select c.source, list(c.line) as lines
        from counts c join totals t using (source)
        where c.n >= {min_times} and c.n > {max_ratio}::double * t.pages group by c.source
    )
    select doc_id, coalesce(len(parts), 0)::bigint as n_lines,
           coalesce(len(parts) - len(kept), 0)::bigint as n_removed,
           sha256(array_to_string(kept, chr(10))) as kept_sha256
    from (select r.*, case when d.lines is null then parts
                      else list_filter(parts, lambda l: not list_contains(d.lines, l)) end as kept
          from read r left join dropped d using (source))"""


def hard_negatives() -> str:
    return """
    with given as (
        select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v,
               case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
        from embeddings
        where label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), scored as (
        select a.vec_id as a, b.vec_id as b, a.label = b.label as same,
               list_inner_product(a.v, b.v)::bigint as s
        from given a join given b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0
    ), positives as (
        select a, b, s from scored where same
        qualify row_number() over (partition by a order by s desc, b) <= 5
    ), paired as (
        select p.a, p.b, p.s, n.b as c, n.s as t,
               row_number() over (partition by p.a, p.b order by n.s desc, n.b) as place
        from positives p join scored n
        on p.a = n.a and not n.same and 80 * p.s <= 100 * n.s and 100 * n.s <= 100 * p.s
    )
    select a as anchor_id, b as positive_id, place::int as rank, c as negative_id,
           s as positive_score, t as negative_score
    from paired where place <= 5"""


def ngram_join(shingle: int = 4, percent: int = 85) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = f"translate(text, '{upper}', '{upper.lower()}')"
    return f"""
    with recursive read as (
        select row_number() over () as id, doc_id, {_words(lowered)} as ws from documents
    ), sets as (
        select id, doc_id, case when len(ws) = 0 then [] when len(ws) < {shingle}
               then [array_to_string(ws, ' ')]
               else list_distinct(list_transform(range(1, len(ws) - {shingle - 2}),
                    lambda i: array_to_string(ws[i:i + {shingle - 1}], ' '))) end as grams
        from read
    ), each as (
        select id, len(grams) as n, unnest(grams) as gram from sets
    ), shared as (
        select a.id as u, b.id as v, any_value(a.n) as n, any_value(b.n) as m, count(*) as met
        from each a join each b on a.gram = b.gram and a.id < b.id group by a.id, b.id
    ), linked as (
        select u, v from shared where 100 * met >= {percent} * (n + m - met)
    ), links as (
        select u, v from linked union all select v, u from linked
    ), reached as (
        select id as u, id as v from sets union select r.u, l.v from reached r join links l on r.v = l.u
    )
    select s.doc_id, any_value(len(s.grams))::bigint as n_shingles, min(o.doc_id) as component_id
    from sets s join reached r on s.id = r.u join sets o on o.id = r.v
    group by s.id, s.doc_id"""


def prefix_trie() -> str:
    bits = "[0, 0, 0, 0, 0, 0, 0, 0]::bigint[]"
    shifted = "case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end"
    digits = "list_transform(range(1, length(c) + 1), lambda i: ascii(c[i])::bigint)"
    crc = (
        f"xor(list_reduce([4294967295]::bigint[] || {digits}, lambda crc, byte: "
        f"list_reduce([xor(crc, byte)]::bigint[] || {bits}, lambda x, y: {shifted})), 4294967295)"
    )
    return f"""
    with ordered as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
               row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as seq
        from conversations where conv_id is not null
    ), convs as (
        select conv_id, {crc} % 4 as h, conv_id - conv_id % 20 as base
        from (select distinct conv_id, conv_id::varchar as c from ordered)
    ), rebuilt as (
        select c.conv_id, 0 as part, o.seq, o.role, o.text
        from convs c join ordered o on o.conv_id = c.base and o.seq < c.h
        union all
        select c.conv_id, 1, o.seq, o.role, o.text
        from convs c join ordered o on o.conv_id = c.conv_id and o.seq >= c.h
    ), pathed as (
        select conv_id, string_agg(sha256(sha256(role) || text), '') over
               (partition by conv_id order by part, seq) as path, len({_words("text")}) as words
        from rebuilt
        union all select conv_id, '', 0 from convs
    ), ends as (
        select path, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends
        from (select conv_id, arg_max(path, length(path)) as path from pathed group by conv_id)
        group by path
    ), nodes as (
        select path, length(path) // 64 as depth, min(conv_id) as conv_id, count(*) as n,
               (count(*) - 1) * any_value(words) as saved
        from pathed group by path
    ), children as (
        select left(path, length(path) - 64) as path, count(*) as n
        from nodes where path <> '' group by 1
    ), over as (
        select left(q.path, 64 * d) as path, q.saved, (c.n is null)::int as leaf
        from (select *, unnest(range(0, depth + 1)) as d from nodes) q
        left join children c on c.path = q.path
    ), sums as (
        select path, sum(saved) as saved, sum(leaf) as leaves from over group by path
    )
    select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n as n_convs,
           coalesce(c.n, 0) as n_children, s.leaves::bigint as n_leaves,
           s.saved::bigint as saved_tokens, coalesce(e.ends, sha256('')) as ends_sha256
    from nodes n join sums s using (path) left join children c using (path) left join ends e using (path)
    left join nodes p on n.path <> '' and p.path = left(n.path, length(n.path) - 64)"""


def substring_dedup(window: int = 20) -> str:
    spots = f"range(1, len(ws) - {window - 2})"
    return f"""
    with read as (
        select row_number() over () as id, doc_id, {_words("text")} as ws from documents
    ), windows as (
        select id, doc_id, unnest(list_transform({spots},
               lambda i: md5(array_to_string(ws[i:i + {window - 1}], ' ')))) as win, unnest({spots}) as pos
        from read where len(ws) >= {window}
    ), firsts as (
        select win, min({{'d': doc_id, 'p': pos}}) as first from windows group by win having count(*) > 1
    ), again as (
        select id, pos from windows join firsts using (win)
        where first < {{'d': doc_id, 'p': pos}}
    ), gone as (
        select distinct id, unnest(range(pos, pos + {window})) as pos from again
    ), each as (
        select id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as pos from read
    ), kept as (
        select id, count(*) as n, string_agg(word, ' ' order by pos) as words
        from each anti join gone using (id, pos) group by id
    )
    select doc_id, len(ws)::bigint as n_words, len(ws) - coalesce(n, 0) as n_removed,
           sha256(coalesce(words, '')) as kept_sha256
    from read left join kept using (id)"""


def decontamination(window: int = 10) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = f"translate(coalesce(text, ''), '{upper}', '{upper.lower()}')"
    found = rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
    with items as (
        select item_id::varchar as item, {found} as ws from benchmark
    ), phrases as (
        select distinct item, least(len(ws), {window}) as n,
               unnest(list_transform(range(1, greatest(1, len(ws) - {window - 1}) + 1),
                      lambda i: array_to_string(ws[i:i + {window - 1}], ' '))) as phrase
        from items where len(ws) > 0
    ), read as (
        select row_number() over () as id, doc_id, {found} as ws from documents
    ), spots as (
        select id, n, unnest(list_transform(range(1, len(ws) - n + 2),
               lambda i: array_to_string(ws[i:i + n - 1], ' '))) as phrase,
               unnest(range(1, len(ws) - n + 2)) as pos
        from read, (select distinct n from phrases) where len(ws) >= n
    ), met as (
        select id, pos, s.n, item from spots s join phrases p on s.phrase = p.phrase and s.n = p.n
    ), hits as (
        select id, count(distinct place) as n_hit
        from (select id, unnest(range(pos, pos + n)) as place from met) group by id
    ), named as (
        select id, count(*) as n, string_agg(item, ',' order by item) as items
        from (select distinct id, item from met) group by id
    )
    select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n, 0) as n_items,
           sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from read left join hits using (id) left join named using (id)"""
