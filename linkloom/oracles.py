"""DuckDB SQL for the registered queries, put together from named parts."""

from __future__ import annotations

import re

from linkloom import config
from linkloom.queries import HARSH, KEY_QUERIES, TIGHT


def _list(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _clean(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower(trim({x})), '[^\p{{L}}\p{{M}}\p{{N}}\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def _expand(x: str, abbreviations: dict[str, str]) -> str:
    cases = " ".join(f"when '{a}' then '{b}'" for a, b in abbreviations.items())
    return f"array_to_string(list_transform({_tokens(x)}, lambda t: case t {cases} else t end), ' ')"


def _name(x: str) -> str:
    return _expand(_clean(x), config.NAME_ABBREVIATIONS)


def _address(x: str) -> str:
    return _expand(_clean(x), config.ADDRESS_ABBREVIATIONS)


def _significant(x: str, least: int = 3) -> str:
    return f"list_filter({_tokens(x)}, lambda t: length(t) >= {least} and t not in ({_list(config.STOP_WORDS)}))"


def _lookalike(t: str) -> str:
    fixed = f"translate({t}, '{config.LOOKALIKE_DIGITS}', '{config.LOOKALIKE_LETTERS}')"
    return rf"case when regexp_matches({t}, '[a-z]') and regexp_matches({t}, '\d') and regexp_matches({fixed}, '^\p{{L}}+$') then {fixed} else {t} end"


def _pair(a: str, b: str) -> str:
    return f"least({a}, {b}) || '|' || greatest({a}, {b})"


def _soundex(x: str) -> str:
    letters = "".join(chr(i) for i in range(97, 123))
    codes = lambda t: f"translate(regexp_replace({t}, '[^a-zA-Z]', '0', 'g'), '{letters}{letters.upper()}', '{2 * '01230127022455012623017202'}')"
    run = f"{codes(f'substr({x}, 1, 1)')} || replace({codes(f'substr({x}, 2)')}, '7', '')"
    for digit in range(1, 7):
        run = f"regexp_replace({run}, '{digit}+', '{digit}', 'g')"
    return f"case when regexp_matches({x}, '^[a-zA-Z]') then upper(substr({x}, 1, 1)) || rpad(substr(replace(substr({run}, 2), '0', ''), 1, 3), 3, '0') else {x} end"


_GENERIC = _list(config.ADDRESS_GENERIC)
_KEY = "country || chr(31) || key_type || chr(31) || txt"

#: Parts by name; a query gets those that it names, and those that they name.
PARTS = {
    "d": r"select doc_id, lang, text, 1 + cast(substr(source, 4) as int) % 3 as src, string_split_regex(trim(text), '\s+') as w from documents",
    "r0": "select 'S' || src || '-' || doc_id as entity_id, src, array_to_string(w[1:6], ' ') as business_name, array_to_string(w[7:18], ' ') as business_address, lang as country, substr(text, 1, 60) as grp, row_number() over (partition by src, lang, substr(text, 1, 60) order by doc_id) as rn from d",
    "er": "select entity_id, cast(src as bigint) as src, business_name, business_address, country, grp from r0 where src > 1 or rn = 1",
    "rec": """select entity_id, src, case when src = 3 then translate(business_name, 'o', '0') else business_name end as business_name,
        concat(case when src = 2 then '0' else '' end, cast(length(grp) * 37 + ascii(grp) * 11 + length(replace(grp, 'e', '')) as varchar), case when src = 3 then 'b' else '' end, ' St, ', business_address) as business_address, country, grp from er""",
    "truth": "select a.entity_id as s1, b.entity_id as cand from er a join er b on a.country = b.country and a.grp = b.grp where a.src = 1 and b.src > 1{more}",
    "normed": f"select entity_id, src, country, {_name('business_name')} as nm, {_address('business_address')} as ad, {_name('strip_accents(business_name)')} as np from rec",
    "block0": f"select entity_id, src, country, list_filter(list_transform({_significant('np')}, lambda t: {_lookalike('t')}), lambda t: t not in ({_list(config.NAME_BLOCK_STOP)})) as l from normed",
    "tok": "select entity_id, src, country, tok, row_number() over (partition by entity_id order by i) as no from (select entity_id, src, country, tok, min(i) as i from (select entity_id, src, country, unnest(l) as tok, generate_subscripts(l, 1) as i from block0) group by all)",
    "part0": "select entity_id, src, country, unnest(p) as part, generate_subscripts(p, 1) as part_no from (select *, string_split(strip_accents(business_address), ',') as p from rec)",
    "part1": f"select entity_id, src, country, part_no, {_tokens(_address('part'))} as l from part0",
    "part2": r"select entity_id, src, country, part_no, i, case when regexp_matches(t, '^\d+[a-z]?$') then coalesce(nullif(ltrim(regexp_extract(t, '^(\d+)', 1), '0'), ''), '0') else t end as t from (select *, unnest(l) as t, generate_subscripts(l, 1) as i from part1)",
    "atok": r"select entity_id, src, country, part_no, i, t, regexp_matches(t, '^\d+$') as num, t in (" + _GENERIC + r") as gen, row_number() over (partition by entity_id order by part_no, i) as pos from part2 where length(t) >= 2 or regexp_matches(t, '^\d+$')",
    "near": f"select * from atok where pos <= {config.DEFAULT.address_tokens}",
    "nums": "select * from (select *, row_number() over (partition by entity_id order by pos) as k from near where num) where k <= 2",
    "keys0": f"""select entity_id, src, country, 1 as key_type, tok as txt from tok
        union select a.entity_id, a.src, a.country, 2, {_pair('a.tok', 'b.tok')} from tok a join tok b on a.entity_id = b.entity_id and a.no < b.no where b.no <= {config.DEFAULT.name_pair_tokens}
        union select * from (select entity_id, src, country, 3, string_agg(tok, '' order by no) as c from tok group by all) where length(c) >= {config.DEFAULT.concat_length}
        union select a.entity_id, a.src, a.country, 4, {_pair('a.t', 'b.t')} from near a join near b on a.entity_id = b.entity_id and a.part_no = b.part_no and a.pos < b.pos where a.t <> b.t and not (a.gen and b.gen)
        union select a.entity_id, a.src, a.country, 4, {_pair('a.t', 'b.t')} from nums a join atok b on a.entity_id = b.entity_id where not b.num and not b.gen""",
    "keyed": f"select entity_id, src, key_type, {_KEY} as key from keys0",
    "q": "select entity_id as s1, key, key_type from keyed where src = 1",
    "p": "select entity_id as cand, src as cand_src, key, key_type from keyed where src > 1",
    "counts": "select key, key_type, count(*) as cnt from p group by all",
    "stats": "select key, key_type, cnt, ln(1 + {cap}.0 / cnt) as weight from counts where cnt <= {cap}",
    "hits": "select q.s1, stats.* from q join stats using (key)",
    "kept": "select * from (select *, sum(cnt) over (partition by s1 order by cnt, key_type, key rows unbounded preceding) as s, row_number() over (partition by s1 order by cnt, key_type, key) as k from hits) where s <= {budget} or k = 1",
    "expanded": "select kept.s1, p.cand, p.cand_src, kept.weight from kept join p using (key)",
    "scored": "select s1, cand, cand_src, sum(weight) as score, count(*) as n_keys from expanded group by all",
    "pairs": "select * from (select *, row_number() over (partition by s1 order by round(score, 6) desc, cand_src, cand) as rank from scored) where rank <= {top}",
    "ref": "select entity_id as s1 from rec where src = 1",
    "ntok": f"select distinct entity_id, src, country, unnest({_significant('nm')}) as t from normed",
    "dtok": f"select distinct entity_id, src, country, unnest({_significant('ad', 2)}) as t from normed",
    "ndf": "select country, t, count(*) as df from ntok where src > 1 group by all",
    "adf": "select country, t, count(*) as df from dtok where src > 1 group by all",
    "grams0": "select entity_id, replace(nm, ' ', '') as z from normed",
    "grams": "select distinct entity_id, substr(z, cast(i as bigint), 3) as g from (select *, unnest(generate_series(1, length(z) - 2)) as i from grams0 where length(z) >= 3)",
    "jac": "select s1, cand, case when na = 0 or nb = 0 then 0.0 else n / (na + nb - n) end as j from (select t.s1, t.cand, (select count(*) from grams x where x.entity_id = t.s1) as na, (select count(*) from grams x where x.entity_id = t.cand) as nb, (select count(*) from grams x join grams y on x.g = y.g where x.entity_id = t.s1 and y.entity_id = t.cand) as n from truth t)",
    "sharedn": "select t.s1, t.cand, count(*) as n, count(*) filter (coalesce(f.df, 0) <= {cap}) as k from truth t join ntok a on a.entity_id = t.s1 join ntok b on b.entity_id = t.cand and a.t = b.t left join ndf f on f.country = a.country and f.t = a.t group by all",
    "shareda": "select t.s1, t.cand, count(*) as n, count(*) filter (coalesce(f.df, 0) <= {cap}) as k from truth t join dtok a on a.entity_id = t.s1 join dtok b on b.entity_id = t.cand and a.t = b.t left join adf f on f.country = a.country and f.t = a.t group by all",
    "known": """select t.s1, t.cand, a.country, x.cand is not null as found, t.s1 in (select s1 from pairs) as has_any, case when b.entity_id is not null then jac.j end as j,
        case when b.entity_id is null then 'missing_record' when a.country <> b.country then 'country_mismatch' when coalesce(sn.n, 0) = 0 then 'no_shared_name_token' when sn.k = 0 then 'shared_only_dropped' else 'shared_kept_truncated' end as cat,
        case when b.entity_id is null then null when t.s1 not in (select entity_id from dtok) or t.cand not in (select entity_id from dtok) then 'addr_empty' when sa.k > 0 then 'addr_rare_shared' when sa.n > 0 then 'addr_only_generic_shared' else 'addr_nothing_shared' end as sig
        from truth t join rec a on a.entity_id = t.s1 left join rec b on b.entity_id = t.cand left join pairs x on x.s1 = t.s1 and x.cand = t.cand
        left join sharedn sn on sn.s1 = t.s1 and sn.cand = t.cand left join shareda sa on sa.s1 = t.s1 and sa.cand = t.cand join jac on jac.s1 = t.s1 and jac.cand = t.cand""",
    "missed": "select *, least(cast(floor(j * 10) as bigint), 9) as decile from known where not found and cat <> 'missing_record'",
    "dfs": "select t.s1, t.cand, a.t || ':' || coalesce(f.df, 0) as x from truth t join ntok a on a.entity_id = t.s1 join ntok b on b.entity_id = t.cand and a.t = b.t left join ndf f on f.country = a.country and f.t = a.t",
    "idl": "select s1, string_agg(cand, ',' order by cand) as ids from truth group by s1",
    "base": "select s1, cast(substr(s1, 4) as bigint) as n, ids from ref left join idl using (s1)",
    "odd": "select s1, n, concat_ws(',', ids, case when n % 13 = 0 then 'S2-5,S2-5' end, case when n % 17 = 0 then 'S1-0' end, case when n % 19 = 0 then 'X-1' end, case when n % 23 = 0 then 'S3-999999999' end) as ids, n % 29 <> 0 as has_tab from base",
    "vrows": "select s1, n, case when has_tab then ids else '' end as ids, has_tab from odd where n % 7 <> 0 union all select s1, n + 1000000000, case when n % 2 = 0 then 'S3-888' else '' end, true from odd where n % 11 = 0 and n % 7 <> 0 union all select 'S1-x' || n, n, '', true from odd where n % 31 = 0",
    "vgood": "select s1, n, ids, case when ids = '' then [] else string_split(ids, ',') end as l from vrows where has_tab",
    "vlast": "select s1, unnest(l) as cand from (select s1, arg_max(l, n) as l from vgood group by s1)",
    "vids": "select s1, unnest(l) as cand from vgood",
    "v_malformed": "select n as line_no from vrows where not has_tab",
    "v_dup": "select s1, count(*) as n from vgood group by s1 having count(*) > 1",
    "v_intra": "select distinct s1 from vgood where len(l) <> len(list_distinct(l))",
    "v_self": "select distinct cand from vids where cand like 'S1-%'",
    "v_prefix": "select distinct cand from vids where not (cand like 'S1-%' or cand like 'S2-%' or cand like 'S3-%')",
    "v_unknown": "select distinct cand from vids where (cand like 'S2-%' or cand like 'S3-%') and cand not in (select entity_id from rec where src > 1)",
    "v_missing": "select s1 from ref where s1 not in (select s1 from vgood)",
    "v_extra": "select distinct s1 from vgood where s1 not in (select s1 from ref)",
    "v_items": """select 'row_without_tab' as rule, 'line ' || lpad(cast(line_no as varchar), 12, ' ') as item from v_malformed union all select 'duplicate_row', s1 from v_dup union all select 'repeated_id', s1 from v_intra
        union all select 'self_match', cand from v_self union all select 'bad_prefix', cand from v_prefix union all select 'missing_row', s1 from v_missing union all select 'extra_row', s1 from v_extra union all select 'unknown_id', cand from v_unknown""",
    "fname": f"select entity_id, np, {_significant('np')} as toks from normed",
    "sound": f"select entity_id, {_soundex('toks[1]')} as sx from fname",
    "code": r"select entity_id, regexp_extract(business_address || ', ' || cast(10000 + length(grp) * 37 + ascii(grp) * 11 as varchar), '(?:^|[^0-9])([0-9]{{5,6}})(?:[^0-9]|$)', 1) as code from rec".replace("{{", "{").replace("}}", "}"),
    "ftok": "select distinct entity_id, t from (select entity_id, unnest(toks) as t from fname)",
    "fgram": "select distinct entity_id, substr(z, cast(i as bigint), 3) as g from (select *, unnest(generate_series(1, length(z) - 2)) as i from (select entity_id, replace(np, ' ', '') as z from normed) where length(z) >= 3)",
    "ntk": "select entity_id, count(*) as n from ftok group by 1",
    "ngr": "select entity_id, count(*) as n from fgram group by 1",
    "stk": "select s1, cand, count(*) as n from pairs join ftok a on a.entity_id = s1 join ftok b on b.entity_id = cand and a.t = b.t group by all",
    "sgr": "select s1, cand, count(*) as n from pairs join fgram a on a.entity_id = s1 join fgram b on b.entity_id = cand and a.g = b.g group by all",
    # levenshtein counts bytes here: what is left beyond ASCII becomes one byte
    "feat": """select x.s1, x.cand, coalesce(stk.n, 0) / greatest(1, coalesce(ta.n, 0) + coalesce(tb.n, 0) - coalesce(stk.n, 0)) as name_jaccard, coalesce(sgr.n, 0) / greatest(1, coalesce(ga.n, 0) + coalesce(gb.n, 0) - coalesce(sgr.n, 0)) as trigram_jaccard,
        case when greatest(length(fa.np), length(fb.np)) = 0 then 0.0 else 1 - levenshtein(regexp_replace(fa.np, '[^\\x00-\\x7f]', '?', 'g'), regexp_replace(fb.np, '[^\\x00-\\x7f]', '?', 'g')) / greatest(length(fa.np), length(fb.np)) end as name_edit
        from pairs x join fname fa on fa.entity_id = x.s1 join fname fb on fb.entity_id = x.cand left join ntk ta on ta.entity_id = x.s1 left join ntk tb on tb.entity_id = x.cand left join ngr ga on ga.entity_id = x.s1 left join ngr gb on gb.entity_id = x.cand
        left join stk on stk.s1 = x.s1 and stk.cand = x.cand left join sgr on sgr.s1 = x.s1 and sgr.cand = x.cand""",
    "conf": "select s1, cand, round((name_jaccard + trigram_jaccard + name_edit) / 3, 6) as c from feat",
    "steps": "select conf.s1, conf.cand, least(cast(floor(c * 20) as bigint), 19) as step, t.s1 is not null as hit from conf left join (select distinct s1, cand from truth) t on t.s1 = conf.s1 and t.cand = conf.cand",
    "tf": "select entity_id, t, count(*) as tf from (select entity_id, unnest(toks) as t from fname) group by all",
    "wt": "select entity_id, tf.t, tf * ln(1 + (select count(*) from rec) / cast(df as double)) as w from tf join (select t, count(*) as df from tf group by t) f on f.t = tf.t",
    "norms": "select entity_id, sqrt(sum(w * w)) as norm from wt group by 1",
}

_NUMBER = "cast(substr(e.entity_id, 4) as bigint)"
_MORE = f""" union all select e.entity_id, 'S2-x' || {_NUMBER} from er e where e.src = 1 and {_NUMBER} % 5 = 0
    union all select e.entity_id, l.cand from er e join (select country, lead(least) over (order by country) as cand from (select country, min(entity_id) as least from er where src > 1 group by country)) l on l.country = e.country
    where e.src = 1 and {_NUMBER} % 3 = 0 and l.cand is not null"""
_LIMITS = {kind: {"cap": c.bucket_cap, "budget": c.fanout_budget, "top": c.top_n, "more": _MORE if kind == "_odd" else ""} for kind, c in (("", config.DEFAULT), ("_tight", TIGHT), ("_harsh", HARSH), ("_odd", HARSH))}


def _sql(body: str, kind: str = "") -> str:
    texts = {name: _limited(text, _LIMITS[kind]) for name, text in PARTS.items()}
    body = _limited(body, _LIMITS[kind])
    names, frontier = set(), [body]
    while frontier:
        text = frontier.pop()
        for name in texts:
            if name not in names and re.search(rf"\b{name}\b", text):
                names.add(name)
                frontier.append(texts[name])
    parts = [f"{n} as ({texts[n]})" for n in texts if n in names]
    return f"with {', '.join(parts)} {body}"


def _limited(text: str, limits: dict) -> str:
    for name, value in limits.items():
        text = text.replace("{" + name + "}", str(value))
    return text


_PLAIN = {
    "clean_name": f"select entity_id, {_clean('business_name')} as value from rec",
    "clean_address": f"select entity_id, {_clean('business_address')} as value from rec",
    "norm_name": "select entity_id, nm as value from normed",
    "norm_address": "select entity_id, ad as value from normed",
    "sig_tokens": f"select entity_id, array_to_string({_significant('nm')}, ' ') as value from normed",
    "strip_accents": "select entity_id, strip_accents(business_name) as value from rec",
    "name_block_tokens": "select r.entity_id, coalesce(x.v, '') as value from rec r left join (select entity_id, string_agg(tok, ' ' order by no) as v from tok group by 1) x on x.entity_id = r.entity_id",
    "name_trigrams": "select r.entity_id, coalesce(x.v, '') as value from rec r left join (select entity_id, string_agg(g, ',' order by g) as v from grams group by 1) x on x.entity_id = r.entity_id",
    "expand_abbrev": f"select distinct t as token, {_expand('t', config.ADDRESS_ABBREVIATIONS).replace('lambda t', 'lambda u').replace('case t', 'case u').replace('else t', 'else u').replace('u: t <>', 'u: u <>')} as expanded from (select unnest({_tokens(_clean('business_address'))}) as t from rec)",
    "fix_lookalike": f"select token, {_lookalike('token')} as fixed from (select distinct unnest({_tokens(_clean('strip_accents(business_name)'))}) as token from rec)",
    "addr_parts": "select entity_id, row_number() over (partition by entity_id order by part_no) - 1 as part_no, value from (select entity_id, part_no, string_agg(t, ' ' order by i) as value from atok group by all)",
    "trigram_jaccard": "select s1, cand, round(j, 6) as jaccard from jac",
    "union_sources": "select entity_id, src, business_name, business_address, country from rec where src > 1",
    "idlist_explode": "select s1, cand from truth",
    "truth_nonempty": "select s1, ids from idl",
    "distinct_ids": "select distinct entity_id from er",
    "read_ids": "select entity_id from er where src = 1",
    "raw_lines": "select value, row_number() over (order by value) as line_no from (select entity_id || chr(9) || country as value from rec)",
    "read_sources": """select entity_id, case when n % 3 = 0 then 'a "b" ' || name else name end as business_name, translate(business_address, chr(34) || chr(9), '') as business_address, case when n % 7 <> 0 then country else '' end as country, src
        from (select *, translate(business_name, chr(34) || chr(9), '') as name, cast(substr(entity_id, 4) as bigint) as n from rec)""",
    "val_files": """select 'short' as file, 'E' as severity, 'matching_missing_row' as rule, count(*) as n from ref where cast(substr(s1, 4) as bigint) % 2 <> 0 union all
        select file, severity, rule, cast(n as bigint) from (values ('good', 'X', 'exit_code', 0), ('comma', 'E', 'matching_comma', 0), ('comma', 'X', 'exit_code', 1), ('header', 'E', 'candidate_header', 0), ('header', 'X', 'exit_code', 1),
        ('empty', 'E', 'matching_empty', 0), ('empty', 'X', 'exit_code', 1), ('encoding', 'E', 'matching_not_utf8', 1), ('encoding', 'E', 'matching_extra_row', 1), ('encoding', 'E', 'matching_unknown_id', 1), ('encoding', 'W', 'match_not_candidate', 1), ('encoding', 'X', 'exit_code', 1),
        ('short', 'X', 'exit_code', 1), ('absent', 'E', 'matching_file_missing', 0), ('absent', 'W', 'candidate_file_absent', 0), ('absent', 'X', 'exit_code', 1), ('no_ids', 'W', 'id_file_absent', 0), ('no_ids', 'X', 'exit_code', 0),
        ('unasked', 'E', 'required_file_missing', 0), ('unasked', 'X', 'exit_code', 1)) v(file, severity, rule, n)""",
    "bucket_counts": "select key, cast(key_type as bigint) as key_type, cnt from counts",
    "truth_histogram": "select n_matches, count(*) as n_entities from (select s1, count(*) as n_matches from truth group by s1) group by 1 order by 2 desc, 1 limit 8",
    "sample_semi": "select entity_id, business_name from rec where entity_id in (select distinct s1 from truth order by s1 limit 20)",
    "truth_sample": "select distinct s1 from truth",
    "country_pivot": "select country, count(*) filter (src = 1) as s1, count(*) filter (src = 2) as s2, count(*) filter (src = 3) as s3, count(*) as total from rec group by 1",
    "top_countries": "select country, count(*) filter (src = 1) as s1, count(*) filter (src = 2) as s2, count(*) filter (src = 3) as s3, count(*) as total from rec group by 1 order by total desc, country limit 3",
    "name_df": "select country, t as token, df from ndf",
    "addr_df": "select country, t as token, df from adf",
    "val_malformed": "select line_no from v_malformed",
    "val_dup_rows": "select s1, n from v_dup",
    "val_intra_dupes": "select s1 from v_intra",
    "val_self": "select cand from v_self",
    "val_prefix": "select cand from v_prefix",
    "val_unknown": "select cand from v_unknown",
    "val_missing": "select s1 from v_missing",
    "val_extra": "select s1 from v_extra",
    "val_subset": "select distinct s1 from vlast where not exists (select 1 from truth where truth.s1 = vlast.s1 and truth.cand = vlast.cand)",
    "validation_report": "select 'E' as severity, rule, count(*) as n, array_to_string(list_sort(list(item))[1:5], ', ') as examples from v_items group by rule",
} | {name: f"select entity_id, cast(key_type as bigint) as key_type, key from keyed where key_type in ({', '.join(map(str, types))})" for name, types in KEY_QUERIES.items()}

#: Registered with the default limits and, under the name and _tight, with small ones.
_LIMITED = {
    "bucket_cap": "select key, cnt from stats",
    "idf_weights": "select key, cast(key_type as bigint) as key_type, round(weight, 6) as weight from stats",
    "query_prune_semi": "select key, cnt from stats where key in (select key from q)",
    "key_lookup": "select s1, key, cnt from hits",
    "fanout": "select s1, cast(sum(cnt) as bigint) as fanout from hits group by 1",
    "fanout_budget": "select s1, key, cnt from kept",
    "expand_postings": "select s1, cand, round(weight, 6) as weight from expanded",
    "scored_candidates": "select s1, cand, round(score, 6) as score, n_keys from scored",
    "topn_candidates": "select s1, cand, round(score, 6) as score, rank from pairs",
    "candidate_pairs": "select ref.s1, coalesce(string_agg(cand, ',' order by rank), '') as candidate_ids, count(cand) as n_candidates from ref left join pairs on pairs.s1 = ref.s1 group by ref.s1",
    "recall": "select count(*) as n_truth, count(x.cand) as n_found, round(count(x.cand) / count(*), 9) as recall from truth t left join pairs x on x.s1 = t.s1 and x.cand = t.cand",
    "f05_macro": """select count(*) as n_s1, round(avg(case when coalesce(t.n, 0) = 0 then case when coalesce(x.n, 0) = 0 then 1.0 else 0.0 end else 1.25 * coalesce(h.n, 0) / (coalesce(x.n, 0) + 0.25 * t.n) end), 9) as f05_macro
        from ref left join (select s1, count(*) as n from truth group by 1) t on t.s1 = ref.s1 left join (select s1, count(*) as n from pairs group by 1) x on x.s1 = ref.s1
        left join (select a.s1, count(*) as n from truth a join pairs b on a.s1 = b.s1 and a.cand = b.cand group by 1) h on h.s1 = ref.s1""",
    "reduction_ratio": "select n1, n23, n_pairs, round(1 - n_pairs / (n1 * n23), 9) as reduction_ratio from (select (select count(*) from rec where src = 1) as n1, (select count(*) from rec where src > 1) as n23, (select count(*) from pairs) as n_pairs)",
}

#: Registered with the default limits and, under the name and _harsh, with limits that lose pairs.
_MISSES = {
    "missed_pairs": "select s1, cand, cast(found as bigint) as found, case when not found then cat end as category, case when not found then sig end as signal, case when not found then round(j, 6) end as jaccard, case when not found and j is not null then least(cast(floor(j * 10) as bigint), 9) end as decile from known",
    "failure_buckets": "select cat as category, count(*) as n, round(count(*) / (select count(*) from known where not found), 9) as share from known where not found group by cat",
    "miss_by_source": "select substr(cand, 1, 2) as source, count(*) as n from missed group by 1",
    "miss_by_country": "select country, count(*) as n from missed group by 1",
    "miss_zero_cand": "select count(*) as n_total, count(*) filter (found) as n_found, count(distinct s1) as n_s1, count(distinct case when not has_any then s1 end) as n_s1_zero, count(*) filter (not found and cat <> 'missing_record' and not has_any) as n_missed_zero, count(*) filter (not found and cat <> 'missing_record' and has_any) as n_missed_some from known",
    "addr_rescue": "select cat as category, sig as signal, count(*) as n from missed group by all",
    "trigram_deciles": "select cat as category, decile, count(*) as n from missed group by all",
}

_TIGHT = {
    "tsv_round_trip": "select s1, cand from pairs",
    "run_stats": """select *, round(n_pairs / n_reference, 9) as pairs_per_record from (select (select count(*) from rec where src = 1) as n_reference, (select count(*) from rec where src > 1) as n_others, (select count(*) from p) as n_postings,
        (select count(*) from counts) as n_keys, (select count(*) from counts where cnt > {cap}) as n_dropped, (select count(*) from stats where key in (select key from q)) as n_usable, (select count(*) from pairs) as n_pairs, (select count(*) from ref where s1 not in (select s1 from pairs)) as n_empty)""",
    "pair_features": "select s1, cand, round(name_jaccard, 6) as name_jaccard, round(trigram_jaccard, 6) as trigram_jaccard, round(name_edit, 6) as name_edit, cast(a.code <> '' and a.code = b.code as bigint) as same_postcode from feat join code a on a.entity_id = s1 join code b on b.entity_id = cand",
    "phonetic": "select s1, cand, cast(coalesce(a.sx = b.sx, false) as bigint) as same_sound from pairs join sound a on a.entity_id = s1 join sound b on b.entity_id = cand",
    "threshold_sweep": """select round(i / 20, 6) as threshold, n_said, n_hit, round(case when n_said > 0 then n_hit / n_said end, 6) as precision, round(n_hit / n_true, 6) as recall, round(1.25 * n_hit / (n_said + 0.25 * n_true), 6) as f05
        from (select i, (select count(*) from steps where step >= i) as n_said, (select count(*) from steps where step >= i and hit) as n_hit, (select count(*) from (select distinct s1, cand from truth)) as n_true from range(20) r(i))""",
    "tfidf_cosine": "select x.s1, x.cand, round(sum(a.w * b.w) / (any_value(na.norm) * any_value(nb.norm)), 6) as cosine from pairs x join wt a on a.entity_id = x.s1 join wt b on b.entity_id = x.cand and a.t = b.t join norms na on na.entity_id = x.s1 join norms nb on nb.entity_id = x.cand group by x.s1, x.cand",
    "matching_results": "select s1, cand, round((name_jaccard + trigram_jaccard + name_edit) / 3, 6) as confidence from feat where (name_jaccard + trigram_jaccard + name_edit) / 3 >= 0.5",
    "lookup_one": """select s1, cand, round(score, 6) as score, rank from (select *, row_number() over (order by round(score, 6) desc, cand_src, cand) as rank from (select h.s1, p.cand, p.cand_src, sum(h.weight) as score from hits h join p using (key)
        where h.s1 = (select min(s1) from ref) group by all)) where rank <= {top}""",
}

_EXAMPLES = """select cat as category, no, m.s1, m.cand, round(j, 6) as jaccard, coalesce(l.x, '') as shared from (select *, row_number() over (partition by cat order by s1, cand) as no from missed) m
    left join (select s1, cand, string_agg(x, ' ' order by x) as x from dfs group by all) l on l.s1 = m.s1 and l.cand = m.cand where no <= 12"""

ORACLES = {name: _sql(body) for name, body in (_PLAIN | _LIMITED | _MISSES).items()} | {"bucket_examples": _sql(_EXAMPLES, "_odd")}
ORACLES |= {name + "_tight": _sql(body, "_tight") for name, body in _LIMITED.items()} | {name: _sql(body, "_tight") for name, body in _TIGHT.items()}
ORACLES |= {name + kind: _sql(body, kind) for name, body in _MISSES.items() for kind in ("_harsh", "_odd")}
