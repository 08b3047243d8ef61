"""URL functions: normalisation, resolution, same-domain test, rewriting."""

from __future__ import annotations

import pandas as pd
from urllib.parse import parse_qs, urlencode, urljoin, urlsplit, urlunsplit

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.schemas import STRIP_PARAMS

#: URLs whose normal form needs no decoding: ASCII, http(s), a host, and a query of plain key=value pairs.
_PLAIN = r"^(?i:https?)://[!-.0-;<=>@-~&&[^;]]+(/[!-~&&[^?#;]]*)?(\?[\w.\-]*(=[\w.\-]*)?(&[\w.\-]*(=[\w.\-]*)?)*)?(#[!-~]*)?$"


def normal_form(url: str | None) -> str | None:
    """The comparison key of a URL, exactly: lower-case scheme (https if there is none) and authority, no trailing slashes,
    parameters, fragment or tracking parameters, other query keys sorted and encoded anew. What can't be parsed is stripped."""
    if url is None:
        return None
    text = url.strip()
    try:
        parts = urlsplit(text)
        # A path's last segment may carry ;parameters, which go.
        head, slash, last = parts.path.rpartition("/")
        path = head + slash + last.split(";", 1)[0] if parts.scheme in ("", "http", "https", "ftp", "hdl", "prospero", "sftp", "shttp", "rtsp", "rtspu", "rtsps", "sip", "sips", "mms", "tel") else parts.path
        kept = [(k, v) for k, v in sorted(parse_qs(parts.query).items()) if k.lower() not in STRIP_PARAMS]
        return urlunsplit((parts.scheme.lower() or "https", parts.netloc.lower(), path.rstrip("/") or "/", urlencode(kept, doseq=True), ""))
    except Exception:
        return text


@F.pandas_udf(T.StringType())
def _normal_form_udf(urls: pd.Series) -> pd.Series:
    return urls.map(normal_form, na_action="ignore")


@F.pandas_udf(T.StringType())
def _join_udf(bases: pd.Series, refs: pd.Series) -> pd.Series:
    def one(base, ref):
        try:
            return urljoin(base or "", ref or "")
        except ValueError:
            return ref

    return pd.Series([one(b, r) for b, r in zip(bases, refs)])


def is_plain(url: Column) -> Column:
    return F.trim(url).rlike(_PLAIN)


def normalise_plain(url: Column) -> Column:
    """The normal form of plain URLs, from built-in functions only."""
    text = F.regexp_replace(F.trim(url), "#.*$", "")
    scheme = F.lower(F.regexp_extract(text, r"^([^:]+)://", 1))
    host = F.lower(F.regexp_extract(text, r"^[^:]+://([^/?]*)", 1))
    path = F.regexp_replace(F.regexp_extract(text, r"^[^:]+://[^/?]*([^?]*)", 1), "/+$", "")
    pairs = F.filter(F.split(F.regexp_extract(text, r"\?(.*)$", 1), "&"), lambda p: p.rlike("=.") & ~F.lower(F.regexp_extract(p, "^[^=]*", 0)).isin(*STRIP_PARAMS))
    # Keys are sorted; the values of one key keep their order.
    keyed = F.array_sort(F.transform(pairs, lambda p, i: F.struct(F.regexp_extract(p, "^[^=]*", 0).alias("k"), i.alias("i"), p.alias("p"))))
    query = F.array_join(F.transform(keyed, lambda x: x["p"]), "&")
    return F.concat(scheme, F.lit("://"), host, F.when(path == "", F.lit("/")).otherwise(path), F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))


def normalise_url(url: Column, exact: bool = True) -> Column:
    """The normal form. Plain URLs never reach Python; with exact, all others do (Arrow), else they are null."""
    plain = F.when(is_plain(url), normalise_plain(url))
    return F.coalesce(plain, _normal_form_udf(F.when(~is_plain(url), url))) if exact else plain


def make_absolute(base: Column, ref: Column, exact: bool = True) -> Column:
    """ref resolved against base. Absolute URLs and plain rooted paths never reach Python."""
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    dots = ref.contains("/.")
    easy = F.when(ref.rlike(r"^(?i:https?)://[^/?#\s]+(/[^\s]*)?$") & ~dots, ref).when(ref.rlike(r"^/(?!/)[^\s]*$") & ~dots & (origin != ""), F.concat(origin, ref))
    return F.coalesce(easy, _join_udf(base, F.when(easy.isNull(), ref))) if exact else easy


def authority(url: Column) -> Column:
    """User, host and port as written; empty where there is none."""
    return F.regexp_extract(F.regexp_replace(url, "#.*$", ""), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)


def bare(host: Column) -> Column:
    """A host as the same-domain test compares it: any leading run of w and . goes, then lower case."""
    return F.lower(F.regexp_replace(host, r"^[w.]+", ""))


def same_domain(url: Column, base: Column, extra: Column | None = None) -> Column:
    """Whether a URL has no host, the base's host, or one of the extra domains."""
    host = bare(authority(url))
    same = (host == "") | (host == bare(authority(base)))
    return same if extra is None else same | F.coalesce(F.exists(extra, lambda d: bare(d) == host), F.lit(False))


def rewrite_url(url: Column, old: Column, new: Column) -> Column:
    """All occurrences of old replaced by new, if both are non-empty."""
    return F.when((F.coalesce(old, F.lit("")) != "") & (F.coalesce(new, F.lit("")) != ""), F.replace(url, old, new)).otherwise(url)


def keep_href(href: Column) -> Column:
    """Links that discovery follows up: not empty, no fragment, no script."""
    return (F.coalesce(href, F.lit("")) != "") & ~href.startswith("#") & ~href.startswith("javascript")
