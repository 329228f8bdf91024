"""The same results in the SQL of an independent engine."""

from . import conversations, mixing, quality, secrets, urls

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in quality.STOP_WORDS.split())


def _rules() -> str:
    tests = []
    for r in quality.RULES:
        tests += [f"({r.denominator} > 0 and 100 * {r.numerator} {op} {bound} * {r.denominator})" for op, bound in (("<", r.low), (">", r.high)) if bound is not None]
    return " or ".join(tests)


OP10 = rf"""
with d as (select doc_id, coalesce(text, '') as text, {_WORDS} as w from documents),
pos as (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d where len(w) > 3),
win as (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as n from pos),
hit as (select distinct doc_id, unnest([i, i + 1, i + 2]) as p from win where n > 1),
rep as (select doc_id, count(*) as n_repeat_words from hit group by doc_id),
ln as (select doc_id, unnest(string_split(text, chr(10))) as l from d),
lc as (select doc_id, count(*) as n_lines, count(*) - count(distinct l) as n_dup_lines from ln
       where regexp_matches(l, '[^\x20\x09-\x0D]') group by doc_id),
m as (select d.doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
        coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_lines, 0) as n_lines,
        coalesce(n_repeat_words, 0) as n_repeat_words,
        len(list_filter(w, lambda x: lower(x) in ({_STOP}))) as n_stop_words
      from d left join rep using (doc_id) left join lc using (doc_id)),
b as (select *, n_words < {quality.LEAST_WORDS} or 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words as base_failed from m)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
  not base_failed and not ({_rules()}) as kept
from b
"""

OP9 = """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
  doc_id = max(doc_id) over g as kept, sha256(coalesce(text, '')) as text_sha256
from documents window g as (partition by coalesce(text, ''))
"""


def _op8() -> str:
    """Proportional fitting as a chain of tables, one for each marginal of each sweep."""
    topic = mixing.topic_sql()
    out = [
        f"""e as (select doc_id, coalesce(source, '{mixing.NONE}') as source, coalesce(lang, '{mixing.NONE}') as lang,
        {topic} as topic, greatest(1, len({_WORDS}))::bigint as n_tokens from documents)""",
        "c as (select source, lang, topic, sum(n_tokens)::bigint as tokens from e group by all)",
    ]
    names = ("source", "lang", "topic")
    for n in names:
        order = f"order by cap / s, {n} rows between"
        out.append(f"o_{n} as (select {n}, sum(tokens)::bigint as cap, pow(sum(tokens)::double, {mixing.TEMPER}) as s from c group by {n})")
        out.append(f"q_{n} as (select {n}, cap, s / sum(s) over () as s from o_{n})")
        out.append(f"""l_{n} as (select {n}, cap, s, ((select sum(tokens) * {mixing.KEEP} from c) - coalesce(sum(cap) over ({order} unbounded preceding and 1 preceding), 0))
            / sum(s) over ({order} current row and unbounded following) as level from q_{n})""")
        out.append(f"t_{n} as (select {n}, case when cap / s <= level then cap::double else s * max(case when cap / s > level then level end) over () end as t_{n} from l_{n})")
    out.append("f0 as materialized (select c.*, tokens::double as weight, t_source, t_lang, t_topic from c join t_source using (source) join t_lang using (lang) join t_topic using (topic))")
    k = 0
    for _ in range(mixing.SWEEPS):
        for n in names:
            out.append(f"f{k + 1} as materialized (select * replace (least(tokens::double, case when sum(weight) over (partition by {n}) > 0 then weight * t_{n} / sum(weight) over (partition by {n}) else 0 end) as weight) from f{k})")
            k += 1
    out.append(f"h as (select source, lang, topic, round(weight / sum(weight) over (), 9) as weight, least(1.0, round(weight / tokens, 9))::double as p from f{k})")
    draw = "('0x' || substr(md5(doc_id || ':0'), 1, 12))::ubigint::double / 281474976710656.0"
    return "with " + ",\n".join(out) + f"\nselect doc_id, source, lang, topic, n_tokens, weight, p, {draw} < p as selected from e join h using (source, lang, topic)"


def _op2() -> str:
    """Each rule's matches placed by the lengths of what lies before them, as rows."""
    out = []
    for k, r in enumerate(secrets.RULES):
        p = "'" + r.pattern.replace("'", "''") + "'"
        out.append(f"""m{k} as (select doc_id, m, v, g, unnest(range(1, len(m) + 1)) as j from (select doc_id, regexp_extract_all(text, {p}, 0) as m,
            regexp_extract_all(text, {p}, {r.group}) as v, string_split_regex(text, {p}) as g from d where regexp_matches(text, {p})))""")
        out.append(f"""s{k} as (select doc_id, {k} as rank, '{r.kind}' as kind, (length(array_to_string(g[1:j], '')) + length(array_to_string(m[1:j - 1], '')))::bigint as start,
            length(m[j]) as own from m{k} where length(v[j]) >= {r.least})""")
    every = " union all ".join(f"select * from s{k}" for k in range(len(secrets.RULES)))
    base = [k for k, r in enumerate(secrets.RULES) if r.base]
    counts = ", ".join(f"count(*) filter (kind = '{r.kind}') as n_{r.kind}" for r in secrets.RULES if r.base)
    written = "string_agg(kind || ':' || start || ':' || (start + own), ',' order by start, rank)"
    names = ", ".join(f"coalesce(n_{r.kind}, 0)::bigint as n_{r.kind}" for r in secrets.RULES if r.base)
    return f"""with d as (select doc_id, coalesce(text, '') as text from documents), {", ".join(out)}, e as ({every}),
    a as (select doc_id, {counts}, {written} as spans, {written} filter (rank in ({", ".join(map(str, base))})) as base from e group by doc_id)
    select d.doc_id, {names}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join a using (doc_id)"""


def _op3() -> str:
    def rules(what: str) -> str:
        longest = sorted(urls.RULES, key=lambda r: (-len(r.text), r.text))
        tests = [f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') then '{getattr(r, what)}'" for r in longest]
        return "case " + " ".join(tests) + " end"

    def rho(level: str) -> str:
        return f"""(select coalesce(least({urls.MOST_RHO}, greatest({urls.LEAST_RHO}, round(case when n - nn / n - (k - 1) > 0 then (q - (k - 1)) / (n - nn / n - (k - 1))
            else {urls.MOST_RHO} end, 9))), {urls.MOST_RHO})::double as rho from (select sum(pow(bad / n - up, 2) * n / (up * (1 - up))) as q, sum(n)::double as n, sum(n * n)::double as nn, count(*) as k from {level} where n > 0))"""

    def shrunk(level: str) -> str:
        return f"(select *, bad + (1 - rho) / rho * up as alpha, n - bad + (1 - rho) / rho * (1 - up) as beta from {level}, {rho(level)} r)"

    bare = "regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '')"
    deep = f"regexp_matches({bare}, '(^|[.])({'|'.join(urls.SECOND.split())})[.]({'|'.join(urls.COUNTRIES.split())})$')"
    number = f"(regexp_matches({bare}, '^[0-9]+([.][0-9]+)+$') or starts_with({bare}, '['))"

    def labels(n: int) -> str:
        last = f"array_to_string((string_split({bare}, '.'))[-{{0}}:], '.')"
        return f"case when {number} then {bare} when {deep} then {last.format(n + 1)} else {last.format(n)} end"

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""with cut as (select page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{upper}', '{upper.lower()}'), '') as host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
    lb as (select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad from labels group by 1),
    oc as (select page_id, max(bad) as bad from (select page_id, try_cast(nullif(regexp_extract(path, '/(\d{{1,18}})(?:\.html|/)?$', 1), '') as bigint) as doc_id from cut) join lb using (doc_id) group by 1),
    ho as (select host, count(bad) as n, coalesce(sum(bad), 0)::bigint as bad from cut left join oc using (page_id) group by 1),
    nm as (select *, {labels(1)} as suffix, {labels(2)} as domain from ho),
    su as (select suffix, sum(n)::bigint as n, sum(bad)::bigint as bad from nm group by 1),
    s1 as (select su.*, (sum(bad) over () + 1.0) / (sum(n) over () + 2.0) as up from su),
    s2 as (select suffix, alpha / (alpha + beta) as up from {shrunk("s1")}),
    d1 as (select suffix, domain, sum(nm.n)::bigint as n, sum(nm.bad)::bigint as bad, min(up) as up from nm join s2 using (suffix) group by 1, 2),
    d2 as (select domain, alpha / (alpha + beta) as up from {shrunk("d1")}),
    h1 as (select nm.host, nm.n, nm.bad, up from nm join d2 using (domain)),
    h2 as (select host, alpha / (alpha + beta) as mean, alpha + beta as total from {shrunk("h1")}),
    h3 as (select host, mean - {urls.Z} * sqrt(mean * (1 - mean) / (total + 1)) as low from h2)
    select page_id, host, path, {rules("text")} as rule, coalesce({rules("verdict")}, case when round(low, 9) > {urls.LIMIT} then 'block' else 'allow' end) as verdict,
        round(low, 6)::double as bad_low from cut left join h3 using (host)"""


OP6 = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sh as (select distinct doc_id, unnest(case when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as x from d),
n as (select doc_id, count(*) as n from sh group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from sh a join sh b using (x) where a.doc_id < b.doc_id group by all),
l as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 85 * (na.n + nb.n - k)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id as node, doc_id as other from d union select r.node, e.b from r join e on e.a = r.other)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.component_id from d left join n using (doc_id)
join (select node, min(other) as component_id from r group by 1) m on m.node = d.doc_id
"""

#: Windows of 35 words as whole lists of words; a word goes if one that begins at most 34 words before it occurs twice.
OP11 = rf"""
with d as (select doc_id, row_number() over () as id, {_WORDS} as w from documents),
p as (select id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i, unnest(list_transform(range(1, len(w) + 1),
        lambda x: case when x <= len(w) - 34 then array_to_string(w[x:x + 34], ' ') end)) as seen from d),
s as (select id, i, word, seen is not null and count(*) over (partition by seen) > 1 as twice from p),
c as (select id, i, word, coalesce(bool_or(twice) over (partition by id order by i rows 34 preceding), false) as gone from s),
k as (select id, count(*) as n_words, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as kept from c group by id)
select doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join k using (id)
"""


def _op12(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Full search in place of pruning: least distance first, then least index."""
    near = f"""select c.id, c.p, c.label, c.x, min(list_sum(list_transform(range(1, len(c.x) + 1), lambda i: (c.x[i] - b.x[i]) * (c.x[i] - b.x[i]))) * {entries} + b.e) as m
        from c join {{book}} b using (p) group by all"""
    out = [
        """v as (select vec_id, label, row_number() over (order by vec_id nulls last, embedding) as id,
        list_transform(embedding, lambda x: floor(x::double * 4096)::bigint) as x from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"c as (select id, label, p::bigint as p, x[p * len(x) // {parts} + 1:(p + 1) * len(x) // {parts}] as x from v, range({parts}) r(p))",
        f"b0 as (select p, id - 1 as e, x from c where id <= {entries})",
    ]
    for i in range(rounds):
        out += [
            f"a{i} as ({near.format(book=f'b{i}')})",
            f"u{i} as (select p, m % {entries} as e, unnest(range(1, len(x) + 1)) as i, unnest(x) as x from a{i})",
            f"t{i} as (select p, e, i, floor(sum(x) / count(*)::decimal(18, 0))::bigint as x from u{i} group by all)",
            f"l{i} as (select p, e, list(x order by i) as x from t{i} group by all)",
            f"b{i + 1} as (select p, e, coalesce(l.x, b.x) as x from b{i} b left join l{i} l using (p, e))",
        ]
    return f"""with {", ".join(x.replace(" as (", " as materialized (", 1) for x in out)},
z as ({near.format(book=f"b{rounds}")}),
f as (select id, string_agg(printf('%02x', m % {entries}), '' order by p) as code, sum(m // {entries})::bigint as error from z group by id),
h as (select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) as codebooks_sha256 from b{rounds})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from f join v using (id), h"""


def _op13() -> str:
    """The checksum bit by bit; the best edits by a table of states that grows row by row."""
    c = conversations
    moves = ", ".join(f"({s}, '{x}', '{e}', {cost}, {to}, {done})" for s in range(4) for x in "suaoxSUAO" for e, cost, to, done in c._choices(x, s))
    ends = ", ".join(f"({s}, '{e}', {len(e) * c.INSERT})" for s, e in enumerate(("", "II", "I", "")))
    blank = r"[\x20\x09-\x0D]"
    crc = "list_reduce([4294967295::bigint] || list_transform(string_split(k, ''), lambda x: ascii(x)::bigint), lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))"
    return rf"""
with recursive o as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
w as (select *, xor({crc}, 4294967295) % 20 as what from o),
r as (select conv_id, turn, case what when 4 then 'user' else role end as role,
    case what when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case what when 3 then 2 else 1 end)) as n from w where what <> 0),
q as (select *, row_number() over g as pos, lag(role[1]) over g as before from r
    window g as (partition by conv_id order by turn nulls first, role, text, n)),
f as (select *, case when not regexp_matches(text, '[^ 	-
]') then 'blank'
    when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
    when not regexp_matches(text, '[.!?]{blank}*\z') then 'truncated' end as fault from q),
l as (select *, case when fault in ('blank', 'duplicate') then 'x' else case when role[1] in ('s', 'u', 'a')
    then case when fault is null then role[1] else upper(role[1]) end else case when fault is null then 'o' else 'O' end end end as letter from f),
move(state, letter, edit, cost, next, done) as (values {moves}),
step as (select m.state, m.letter, m.edit as edits, m.cost, m.next from move m where m.done
    union all select a.state, b.letter, a.edit || b.edit, a.cost + b.cost, b.next from move a join move b on not a.done and b.done and a.next = b.state and a.letter = b.letter
    union all select a.state, x.letter, a.edit || b.edit || x.edit, a.cost + b.cost + x.cost, x.next from move a
      join move b on not a.done and not b.done and a.next = b.state and a.letter = b.letter join move x on x.done and b.next = x.state and b.letter = x.letter),
dp as (select distinct conv_id, 0::bigint as pos, 0 as state, 0 as cost, '' as audit from l
    union all select conv_id, pos, state, cost, audit from (
      select d.conv_id, l.pos, s.next as state, d.cost + s.cost as cost, d.audit || s.edits as audit,
        row_number() over (partition by d.conv_id, s.next order by d.cost + s.cost, d.audit || s.edits) as k
      from dp d join l on l.conv_id is not distinct from d.conv_id and l.pos = d.pos + 1 join step s on s.state = d.state and s.letter = l.letter) where k = 1),
fin(state, edits, cost) as (values {ends}),
best as (select conv_id, cost, audit from (select d.conv_id, d.cost + e.cost as cost, d.audit || e.edits as audit,
    row_number() over (partition by d.conv_id order by d.cost + e.cost, d.audit || e.edits) as k
    from dp d join fin e using (state) join (select conv_id, max(pos) as pos from l group by all) z on z.conv_id is not distinct from d.conv_id and z.pos = d.pos) where k = 1),
e as (select conv_id, audit, unnest(range(1, length(audit) + 1)) as i from best),
told as (select conv_id, i, audit[i] as edit, length(replace(audit[:i], 'I', '')) as pos,
    (length(replace(audit[:i], 'D', '')) - 1 + length(replace(audit, 'D', ''))) % 2 as second from e),
m as (select told.conv_id, i, case when edit = 'K' then role when second = 0 then 'user' else 'assistant' end || ':' || case when edit = 'I' then '' else text end as line
    from told left join l on edit <> 'I' and l.conv_id is not distinct from told.conv_id and l.pos = told.pos where edit <> 'D'),
h as (select conv_id, string_agg(line, chr(10) order by i) as whole from m group by all),
n as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (before is not null and before || role[1] not in ('su', 'ua', 'au')) as illegal from l group by all)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit,
  sha256(coalesce(whole, '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join n on n.conv_id is not distinct from c.conv_id
left join best b on b.conv_id is not distinct from c.conv_id left join h on h.conv_id is not distinct from c.conv_id
"""


ORACLE_SQL: dict[str, str] = {
    "op2_secret_ledger": _op2(),
    "op3_url_reputation": _op3(),
    "op6_ngram_jaccard": OP6,
    "op8_source_mixing": _op8(),
    "op9_exact_dedup": OP9,
    "op10_quality_rules": OP10,
    "op11_relative_lz": OP11,
    "op12_annular_codes": _op12(),
    "op13_signature_repair": _op13(),
}
