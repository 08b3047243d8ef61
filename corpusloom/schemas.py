"""Schemas of the tables, as DDL, and fixed values that results depend on."""

SITES = (
    "name string, country string, country_code string, base_url string, rss_url string, listing_urls array<string>, pagination string, pagination_step int, max_pages int, "
    "js_required boolean, wait_selector string, extra_domains array<string>, selectors struct<article_links: string, title: string, date: string, date_attr: string, body: string>, "
    "url_rewrite struct<`from`: string, `to`: string>, tags array<string>"
)
CANDIDATE = "source string, country_code string, norm_url string, url string, title string, date string, ord long"
RESPONSE = "url string, html string, etag string, last_modified string, status int"
CHECKPOINT = "source string, url_key string, etag string, last_modified string, chash string"
ARTICLE = "source string, country string, country_code string, title string, date string, url string, body string, scraped_at string, word_count int, unique_id string"
INDEX = "country_code string, norm_url string, url string, title string, date string, source string, scraped_at string, content_hash string, unique_id string"
RUN_STATS = "country_code string, saved long, skipped long, errors long"
ROBOTS = "origin string, robots_txt string"

#: Query parameters that do not tell pages apart.
STRIP_PARAMS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "ref", "source", "_ga")
#: Feed paths tried in this order where the named feed is empty.
FEED_PATHS = ("/feed", "/feed/", "/rss.xml", "/rss", "/en/feed", "/en/rss.xml", "/actualites.atom")
#: What is removed from an article's body.
JUNK_SELECTORS = (
    "nav", "footer", "script", "style", "aside", "header", ".skip-link", ".breadcrumb", ".related", ".share", ".social", ".cookie-banner", ".cookie-notice", "[aria-hidden='true']", ".site-header", ".site-footer", ".sidebar",
)
#: Fixed value: the agent by which robots rules and pages are asked for.
USER_AGENT = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0.0.0 Safari/537.36"
#: Bodies with fewer code points are not articles.
MIN_BODY = 300
TITLE_LENGTH = 500
CHUNK_LENGTH = 4500
ARCHIVE_MONTHS = 24
MAX_ARTICLES = 99_999
