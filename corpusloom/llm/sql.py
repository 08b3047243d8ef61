"""DuckDB SQL with the results of the queries, where SQL can express them."""

from __future__ import annotations

from corpusloom.llm import fingerprint

_BLANK = r"[\x20\x09-\x0D]"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '{_BLANK}+'), lambda w: w <> '')"


MIXING = f"""
with d as (select doc_id, source, len({_words('text')})::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as place from d group by source),
w as (select *, (place - 1) % 3 + 1 as weight, 3 * source_size as top from s),
o as (select *, row_number() over (order by top / weight, source nulls last) as turn from w),
l as (select *, (sum(source_size) over () - coalesce(sum(top) over (order by turn rows between unbounded preceding and 1 preceding), 0)) / (sum(weight) over () - coalesce(sum(weight) over (order by turn rows between unbounded preceding and 1 preceding), 0)) as level from o),
f as (select level from l where level <= top / weight order by turn limit 1),
t as (select source, source_size, least(top::double, coalesce((select level from f) * weight, top::double)) as target from l)
select doc_id, size, source_size, target from d join t on d.source is not distinct from t.source"""

# A set of words stands where it stands first; a line is removed if an earlier one has the same or a similar set.
LINEDEDUP = f"""
with l as (select doc_id, coalesce(string_split(text, chr(10)), []) as lines from documents),
x as (select doc_id, unnest(lines) as line, unnest(range(len(lines))) as pos from l),
w as (select doc_id, pos, list_sort(list_distinct({_words('line')})) as ws, row_number() over (order by doc_id, pos) as ord from x),
e as (select ws, len(ws) as n, min(ord) as id from w where len(ws) > 0 group by ws),
u as (select id, n, unnest(ws) as word from e),
f as (select word, count(*) as often from u group by word),
r as (select id, n, word, row_number() over (partition by id order by often, word) as place from u join f using (word)),
p as (select id, n, word from r where place <= n - ceil(n * 4 / 5) + 1),
c as (select distinct a.id as early, b.id as late from p a join p b on a.word = b.word and a.id < b.id and 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
g as (select distinct c.late as id from c join e a on a.id = c.early join e b on b.id = c.late where 9 * len(list_intersect(a.ws, b.ws)) >= 4 * (a.n + b.n)),
k as (select w.doc_id, w.pos from w join e using (ws) left join g on g.id = e.id where w.ord > e.id or g.id is not null)
select l.doc_id, len(any_value(l.lines))::bigint as n_lines, count(k.pos)::bigint as n_removed, coalesce(string_agg(k.pos, ',' order by k.pos), '') as removed
from l left join k on k.doc_id = l.doc_id group by l.doc_id"""

NGRAMJOIN = f"""
with recursive d as (select doc_id, {_words(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} as ws from documents),
h as (select doc_id, list_sort(list_distinct(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')] else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end)) as sh from d),
s as (select sh, len(sh) as n, min(doc_id) as id from h where len(sh) > 0 group by sh),
u as (select id, n, unnest(sh) as one from s),
k as (select a.id as a, b.id as b from u a join u b on a.one = b.one and a.id < b.id group by a.id, b.id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e as (select a, b from k union all select b, a from k),
reach(node, other) as (select id, id from s union select e.b, reach.other from reach join e on e.a = reach.node),
c as (select node, min(other) as least from reach group by node)
select h.doc_id, len(h.sh)::bigint as n_shingles, coalesce(c.least, h.doc_id) as component_id from h left join s on s.sh = h.sh and len(h.sh) > 0 left join c on c.node = s.id"""


def _found(kind: str, place: int, pattern: str, keep: str) -> str:
    """Rows of the matches of a pattern that are kept, with their offsets in code points: those of the text between them, added up."""
    pattern = pattern.replace("'", "''")
    lists = f"select doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') as m, regexp_split_to_array(coalesce(text, ''), '{pattern}') as g from documents"
    size = lambda x: f"coalesce(list_sum(list_transform({x}, lambda y: length(y))), 0)"
    rows = f"select doc_id, m[i] as hit, ({size('g[1:i]')} + {size('m[1:i - 1]')})::bigint as start from (select *, unnest(range(1, len(m) + 1)) as i from ({lists}))"
    return f"select doc_id, '{kind}' as kind, {place} as place, start, start + length(hit) as stop from ({rows}) where {keep}"


def _spans(parts: list[str], kinds: list[str], order: str) -> str:
    count = ", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in kinds)
    joined = f"coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by {order}), '')"
    return f"with f as ({' union all '.join(parts)}) select doc_id, {count}, sha256({joined}) as base_sha256 from documents left join f using (doc_id) group by doc_id"


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYS = "|".join([*map(_either, ("password", "passwd", "secret", "token")), _either("api") + "_?" + _either("key")])
SECRETS = _spans(
    [
        _found("assign", 0, rf"(?:{_KEYS})[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+", rf"length(regexp_extract(hit, '^(?:{_KEYS})[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)', 1)) >= 6"),
        _found("access", 1, "AKIA[A-Z0-9]+", "length(hit) >= 20"),
        _found("hex", 2, "[0-9a-f]+", "length(hit) >= 24"),
    ],
    ["assign", "access", "hex"],
    "start, place",
)

_DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
# Every second digit from the right counts twice, less 9 if that is above 9.
_DIGIT = f"substr(reverse({_DIGITS}), i + 1, 1)::int"
_LUHN = f"list_sum(list_transform(range(length({_DIGITS})), lambda i: case when i % 2 = 0 then {_DIGIT} when {_DIGIT} > 4 then 2 * {_DIGIT} - 9 else 2 * {_DIGIT} end)) % 10 = 0"
PII = _spans(
    [
        _found("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
        _found("ip", 1, r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "list_bool_and(list_transform(string_split(hit, '.'), lambda x: coalesce(try_cast(x as hugeint) <= 255, false)))"),
        _found("card", 2, r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) between 13 and 19 and {_LUHN}"),
        _found("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) between 9 and 15"),
    ],
    ["email", "ip", "card", "phone"],
    "place, start",
)

_PIECES = rf"(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*){{1,{fingerprint.PIECE}}}"
FINGERPRINT = f"""
with t as (select doc_id, coalesce(text, '') as text from documents),
x as (select *, coalesce(lead(text) over (order by doc_id), first_value(text) over (order by doc_id)) as after from t),
e as (select doc_id, text, after, left(text, length(text) - length(text) // 2) || left(after, length(text) // 2) as edited from x),
k as (select *, {', '.join(f"list_distinct(list_transform(regexp_extract_all({c}, '{_PIECES}'), lambda p: rtrim(p))) as k_{c}" for c in ('text', 'edited', 'after'))} from e)
select doc_id, length(text)::bigint as n_chars, sha256(edited) as edited_sha256,
{', '.join(f"case when len(k_text) + len(k_{o}) = 0 then 1.0::double else 1 - (len(k_text) + len(k_{o}) - 2 * len(list_intersect(k_text, k_{o})))::double / (len(k_text) + len(k_{o})) end as {n}" for o, n in (('edited', 'near_edited'), ('after', 'near_next')))} from k"""

QUALITY = f"""
with d as (select doc_id, coalesce(text, '') as text, {_words('text')} as ws from documents),
n as (select doc_id, unnest(range(1, len(ws) - 1)) as i, ws from d),
g as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as one from n),
m as (select doc_id, i, count(*) over (partition by doc_id, one) as often from g),
r as (select doc_id, count(distinct spot) as n_repeat_words from (select doc_id, unnest([i, i + 1, i + 2]) as spot from m where often > 1) group by doc_id),
b as (select doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words from d left join r using (doc_id))
select doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from b"""

ORACLE = {"mixing_targets": MIXING, "op4_linededup": LINEDEDUP, "secrets_base": SECRETS, "op6_ngramjoin": NGRAMJOIN, "pii_base": PII, "fingerprint_base": FINGERPRINT, "quality_base": QUALITY}
