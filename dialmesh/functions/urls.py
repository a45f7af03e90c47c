"""URL checks and URL keys as column expressions.

``parse_url`` of Spark rejects host names with underscores and has no notion of
a default scheme, so the parts are cut out with one regular expression and the
rules are applied as a ``CASE`` chain.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col, bind, percent_escape, trim_space

# Error codes used in ``error`` columns.
INVALID_URL = "invalid_url"
MISSING_HOST = "missing_host"
INVALID_SCHEME = "invalid_scheme"

_PARTS = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*+):)?+(?://([^/?#]*+))?+([^?#]*+)(\?[^#]*+)?+(?:#(.*))?+$"
)
_BAD_ESCAPE = r"%(?![0-9A-Fa-f]{2})"
_HOST_CHARS = r"A-Za-z0-9!$&'()*+,;=:\[\]<>\"\-_.~"
_GOOD_HOST = rf"^(?:[{_HOST_CHARS}]|[^\x00-\x7f]|%[89A-Fa-f][0-9A-Fa-f]|%25)*+$"
_GOOD_USER = r"^[A-Za-z0-9\-._:~!$&'()*+,;=%@]*+$"
_PATH_CHARS = r"A-Za-z0-9\-_.~!$&'()*+,;=:@\[\]%/"
_FRAGMENT_CHARS = r"A-Za-z0-9\-_.~!$&'()*+,;=:@\[\]%/?"


# Addresses that need no closer look: a bare host, or lower-case http(s) with a plain
# host and only unescaped characters.  They are by far the most frequent.
_PLAIN = (
    r"^(?:https?://[A-Za-z0-9.\-]++(?::[0-9]++)?+(?:/[A-Za-z0-9\-_.~!$&'()*+,;=:@/]*+)?+"
    r"(?:\?[\x21\x22\x24-\x7e]*+)?+|[A-Za-z0-9.\-]++)$"
)
_PLAIN_HOST = r"^(?:https?://)?+([^/?]*+)"


def url_parts(url: Column | str) -> Column:
    """Split into ``struct<scheme, authority, path, query, fragment>``.

    ``query`` keeps its ``?``; a part that is absent is the empty string.
    """
    raw = as_col(url)

    def group(i: int) -> Column:
        return F.regexp_extract(raw, _PARTS, i)

    return F.struct(
        F.lower(group(1)).alias("scheme"),
        group(2).alias("authority"),
        group(3).alias("path"),
        group(4).alias("query"),
        group(5).alias("fragment"),
    )


def _user_of(authority: Column) -> Column:
    return F.regexp_extract(authority, r"(?s)^(.*)@", 1)


def _host_of(authority: Column) -> Column:
    return F.regexp_replace(authority, r"(?s)^.*@", "")


def _bad_host(host: Column) -> Column:
    bracketed = host.startswith("[")
    return (
        ~host.rlike(_GOOD_HOST)
        | (bracketed & ~host.rlike(r"\](?::[0-9]*+)?+$"))
        | (~bracketed & host.contains(":") & ~host.rlike(r":[0-9]*+$"))
    )


def _syntax_error(raw: Column, parts: Column) -> Column:
    authority = parts["authority"]
    user = _user_of(authority)
    return (
        raw.rlike(r"^[^#]*?[\x00-\x1f\x7f]")
        | raw.startswith(":")
        | ((parts["scheme"] == "") & raw.rlike(r"^[^/?#:]++:"))
        | ~user.rlike(_GOOD_USER)
        | user.rlike(_BAD_ESCAPE)
        | bind(_host_of(authority), _bad_host)
        | parts["path"].rlike(_BAD_ESCAPE)
        | parts["fragment"].rlike(_BAD_ESCAPE)
    )


def syntax_error(url: Column | str) -> Column:
    """True where the text cannot be read as a URL at all."""
    raw = as_col(url)
    return bind(url_parts(raw), lambda parts: _syntax_error(raw, parts))


def _assemble(parts: Column, path: Column) -> Column:
    user = _user_of(parts["authority"])
    fragment = percent_escape(parts["fragment"], _FRAGMENT_CHARS)
    return F.concat(
        F.when(parts["scheme"] != "", F.concat(parts["scheme"], F.lit(":"))).otherwise(""),
        F.lit("//"),
        F.when(user != "", F.concat(user, F.lit("@"))).otherwise(""),
        percent_escape(_host_of(parts["authority"]), _HOST_CHARS + "%"),
        path,
        parts["query"],
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )


def _normal(parts: Column) -> Column:
    return _assemble(parts, percent_escape(parts["path"], _PATH_CHARS))


def normal_url(url: Column | str) -> Column:
    """Text form of an absolute URL: scheme in lower case, odd characters escaped."""
    return bind(url_parts(url), _normal)


def host_name(host: Column | str) -> Column:
    """Host without port and without the brackets of an IPv6 address."""
    bare = F.regexp_replace(as_col(host), r":[0-9]*+$", "")
    return F.regexp_replace(bare, r"^\[(.*)\]$", "$1")


def parse_url_checked(value: Column | str) -> Column:
    """Trim, default the scheme to https and check.

    Gives ``struct<url, scheme, host, hostname, error>``; ``error`` is NULL for a
    good URL, and the other fields are NULL for a bad one.
    """

    def checked(raw: Column, parts: Column) -> Column:
        host = _host_of(parts["authority"])
        error = (
            F.when(raw == "https://", F.lit(MISSING_HOST))  # nothing but the default
            .when(_syntax_error(raw, parts), F.lit(INVALID_URL))
            .when(host == "", F.lit(MISSING_HOST))
            .when(~parts["scheme"].isin("http", "https"), F.lit(INVALID_SCHEME))
        )

        def result(code: Column) -> Column:
            good = code.isNull()
            return F.struct(
                F.when(good, _normal(parts)).alias("url"),
                F.when(good, parts["scheme"]).alias("scheme"),
                F.when(good, host).alias("host"),
                F.when(good, host_name(host)).alias("hostname"),
                code.alias("error"),
            )

        return bind(error, result)

    def closer_look(text: Column) -> Column:
        full = F.when(text.contains("://"), text).otherwise(F.concat(F.lit("https://"), text))
        return bind(full, lambda raw: bind(url_parts(raw), lambda parts: checked(raw, parts)))

    def plain(text: Column) -> Column:
        host = F.regexp_extract(text, _PLAIN_HOST, 1)
        has_scheme = text.contains("://")
        return F.struct(
            F.when(has_scheme, text).otherwise(F.concat(F.lit("https://"), text)).alias("url"),
            F.when(text.startswith("http://"), F.lit("http"))
            .otherwise(F.lit("https"))
            .alias("scheme"),
            host.alias("host"),
            F.substring_index(host, ":", 1).alias("hostname"),
            F.lit(None).cast("string").alias("error"),
        )

    return bind(
        trim_space(F.coalesce(as_col(value), F.lit(""))),
        lambda text: F.when(text.rlike(_PLAIN), plain(text)).otherwise(closer_look(text)),
    )


def company_id(url: Column | str) -> Column:
    """Key of the company table: the checked URL's host name (NULL for a bad URL)."""
    return parse_url_checked(url)["hostname"]


def url_host(url: Column | str) -> Column:
    """Host (with port) of a URL text, empty when there is none."""
    return _host_of(url_parts(url)["authority"])


def allowed_host(host: Column | str, seed_host: Column | str) -> Column:
    """A site's visits stay on the seed's host or its ``www.`` form."""
    seed = as_col(seed_host)
    return as_col(host).isin(seed, F.concat(F.lit("www."), seed))


def robots_url(url: Column | str) -> Column:
    """Address of the site's robots file; the query is kept, the fragment is not sent."""
    return capture_key(bind(url_parts(url), lambda p: _assemble(p, F.lit("/robots.txt"))))


def capture_key(url: Column | str) -> Column:
    """Key under which a body is captured: fragments never reach the server."""
    return F.regexp_replace(as_col(url), r"(?s)#.*$", "")


def visit_url(link: Column | str) -> Column:
    """URL that a visit of ``link`` would request; relative links keep no host.

    NULL when the text cannot be read as a URL.  ``//host/x`` gets the scheme http.
    """

    def requested(raw: Column, parts: Column) -> Column:
        normal = _normal(parts)
        with_scheme = F.when(
            parts["scheme"] == "", F.concat(F.lit("http:"), normal)
        ).otherwise(normal)
        has_host = _host_of(parts["authority"]) != ""
        return F.when(
            ~_syntax_error(raw, parts), F.when(has_host, with_scheme).otherwise(raw)
        )

    return bind(as_col(link), lambda raw: bind(url_parts(raw), lambda p: requested(raw, p)))
