"""Text and links of an HTML page as column expressions.

One left-to-right regular expression plays the tokeniser: comments, script and
style elements, other elements with raw content, tags with quoted attributes.
Quantifiers are possessive, so every scan is linear in the page and needs no
backtracking stack.  A page never leaves the JVM.

Limits: a ``<nav>`` without end tag runs to the end of the page, and the
double-escaped state of scripts (``<!-- <script>`` inside a script) is not kept.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col, bind, trim_space

# --- pieces of the tokeniser -------------------------------------------------
_END = r"(?=[\s/>])"
_BODY = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+"
_CLOSE = r"(?:>|\z)"
# All of these follow a "<", which the patterns below factor out.
_COMMENT = r"!--(?:-?>|.*?(?:--!?>|\z))"
_BOGUS = rf"[!?][^>]*+{_CLOSE}|/(?![A-Za-z])[^>]+{_CLOSE}|/>"
_TAG = rf"/?[A-Za-z]{_BODY}{_CLOSE}"


def _raw_element(names: str, group: int) -> str:
    """Element whose content holds no tags, up to its own end tag or the end."""
    return rf"({names}){_END}{_BODY}(?:>.*?(?:</\{group}{_END}{_BODY}{_CLOSE}|\z)|\z)"


_KEPT_RAW = "noscript|iframe|noembed|noframes|xmp"
_KEPT_TEXT = "textarea|title"

_HEAD = (
    rf"(?is)^(?:\s++|<(?:{_COMMENT}|[!?][^>]*+{_CLOSE}"
    rf"|/?(?:html|head){_END}{_BODY}{_CLOSE}"
    rf"|(?:meta|link|base|basefont|bgsound){_END}{_BODY}{_CLOSE}"
    rf"|{_raw_element('title|style|script|noscript|noframes|template', 1)}"
    rf"))*+(?:<body{_END}{_BODY}{_CLOSE})?+"
)
_MARKUP = rf"(?is)<(?:{_COMMENT}|{_raw_element('script|style', 1)}|{_TAG}|{_BOGUS})"
_HAS_RAW_TEXT = rf"(?is)<(?:{_KEPT_RAW}|{_KEPT_TEXT}){_END}"
_PIECE = (
    rf"(?is)[^<]++|<(?:{_COMMENT}|{_raw_element('script|style', 1)}"
    rf"|{_raw_element(_KEPT_RAW, 2)}|{_raw_element(_KEPT_TEXT, 3)}|{_TAG}|{_BOGUS})|<"
)
_STRIP_OWN_TAGS = (
    rf"(?is)^<[a-z]{_BODY}{_CLOSE}|</(?:{_KEPT_RAW}|{_KEPT_TEXT}){_END}{_BODY}{_CLOSE}\z"
)
_LINK_TAG = (
    rf"(?is)\G(?:[^<]++|<(?:{_COMMENT}"
    rf"|{_raw_element('script|style|' + _KEPT_RAW + '|' + _KEPT_TEXT, 1)}"
    rf"|(?!/?nav[\s/>]|a[\s/>])/?[A-Za-z]{_BODY}{_CLOSE}|{_BOGUS}|(?![A-Za-z/!?])))*+"
    rf"(<(?:a|/?nav){_END}{_BODY}>)"
)
# First attribute named href; the value group keeps its quotes.
_HREF = (
    r"(?is)^<a[\s/]++(?:(?!href[\s=/>])[^\s=>/]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+"
    r"[\s/]*+)*+(href(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+)"
)

# --- character references ----------------------------------------------------
_REFERENCE = r"&(?:#[0-9]++;?+|#[xX][0-9A-Fa-f]++;?+|[A-Za-z][A-Za-z0-9]*+;?+)"
_COMMON = ["amp", "nbsp", "quot", "lt", "gt", "copy", "middot", "apos", "mdash", "ndash", "rsquo"]
_NAMES = sorted({n[:-1] for n in html5 if n.endswith(";")} - set(_COMMON))
# Names that also work without a semicolon, longest first.
_BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_BARE_PREFIX = rf"^&({'|'.join(_BARE)})"
# Numeric references 128-159 mean Windows-1252 characters.
_C1 = {
    code: bytes([code]).decode("cp1252")
    for code in range(128, 160)
    if code not in (129, 141, 143, 144, 157)
}
_MARK = "\u0000"


def _literal_map(pairs: list[tuple]) -> Column:
    """A string map as one foldable expression (separators U+0001 and U+0002)."""
    text = "\u0001".join(f"{key}\u0002{value}" for key, value in pairs)
    return F.str_to_map(F.lit(text), F.lit("\u0001"), F.lit("\u0002"))


def _named(names: list[str]) -> Column:
    return _literal_map([(n, html5[n + ";"]) for n in names])


def _numeric_reference(ref: Column) -> Column:
    digits = F.regexp_replace(ref, r"^&#[xX]?0*|;$", "")
    number = F.when(ref.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)
    code = F.when(F.length(digits) > 8, F.lit(0x110000)).otherwise(number.try_cast("bigint"))

    def character(c: Column) -> Column:
        bad = (c == 0) | (c > 0x10FFFF) | c.between(0xD800, 0xDFFF)
        plain = F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32")
        c1 = F.try_element_at(_literal_map(sorted(_C1.items())), c.cast("string"))
        return F.when(bad, F.lit("\ufffd")).otherwise(F.coalesce(c1, plain))

    return bind(F.coalesce(code, F.lit(0)), character)


def _reference_value(ref: Column, in_attribute: bool) -> Column:
    def by_name(bare: Column) -> Column:
        # The whole name with its semicolon, else a bare name and what is glued to
        # it; in an attribute a bare name counts only when nothing is glued to it.
        whole = ref.endswith(";")
        rest = F.substr(ref, F.length(bare) + 2)
        glued = (rest != "") if in_attribute else F.lit(False)
        name = F.regexp_replace(ref, "[&;]", "")
        return F.coalesce(
            F.when(whole, F.try_element_at(_named(_COMMON + _NAMES), name)),
            F.when((bare != "") & ~glued, F.concat(F.try_element_at(_named(_BARE), bare), rest)),
            ref,
        )

    return F.when(ref.startswith("&#"), _numeric_reference(ref)).otherwise(
        bind(F.regexp_extract(ref, _BARE_PREFIX, 1), by_name)
    )


def decode_references(text: Column | str, in_attribute: bool = False) -> Column:
    """Replace HTML character references (named and numeric) by their characters."""
    body = as_col(text)
    pattern = _REFERENCE + r"(?!=)" if in_attribute else _REFERENCE
    refs = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    decoded = F.transform(refs, lambda r: _reference_value(r, in_attribute))
    pieces = F.zip_with(
        F.split(body, pattern, -1), decoded, lambda gap, d: F.concat(gap, F.coalesce(d, F.lit("")))
    )
    return F.when(body.contains("&"), F.array_join(pieces, "")).otherwise(body)


# --- text --------------------------------------------------------------------
def body_text(html: Column | str) -> Column:
    """Text of the body without script and style; nothing is put between elements."""

    def careful(body: Column) -> Column:
        """Pages with raw-text elements: their content is text, never markup."""

        def piece_text(piece: Column) -> Column:
            inner = F.regexp_replace(piece, _STRIP_OWN_TAGS, "")
            return (
                F.when(
                    piece.rlike(rf"(?is)^<(?:{_KEPT_RAW}){_END}"),
                    F.replace(inner, F.lit("&"), F.lit("&amp;")),
                )
                .when(piece.rlike(rf"(?is)^<(?:{_KEPT_TEXT}){_END}"), inner)
                .when(piece.startswith("<") & (F.length(piece) > 1), F.lit(_MARK))
                .otherwise(piece)
            )

        pieces = F.regexp_extract_all(body, F.lit(_PIECE), F.lit(0))
        return F.array_join(F.transform(pieces, piece_text), "")

    def marked(body: Column) -> Column:
        # The mark keeps references on both sides of a tag apart until decoded.
        return F.when(body.rlike(_HAS_RAW_TEXT), careful(body)).otherwise(
            F.regexp_replace(body, _MARKUP, _MARK)
        )

    body = F.regexp_replace(as_col(html), _HEAD, "")
    text = bind(bind(body, marked), decode_references)
    return F.replace(text, F.lit(_MARK), F.lit(""))


# --- links -------------------------------------------------------------------
def _href_value(tag: Column) -> Column:
    quoted = F.regexp_extract(tag, _HREF, 2)
    value = bind(
        quoted,
        lambda q: F.when(
            q.startswith('"') | q.startswith("'"), F.substr(q, F.lit(2), F.length(q) - 2)
        ).otherwise(q),
    )
    return bind(value, lambda v: decode_references(v, in_attribute=True))


def link_tags(html: Column | str) -> Column:
    """``array<struct<step, href>>`` of nav and a tags in document order.

    ``step`` is +1 for ``<nav>``, -1 for ``</nav>`` and 0 for an ``a`` with an href.
    """
    tags = F.regexp_extract_all(as_col(html), F.lit(_LINK_TAG), F.lit(2))
    items = F.transform(
        tags,
        lambda t: F.struct(
            F.when(t.rlike("^</"), -1).when(t.rlike("^<[nN]"), 1).otherwise(0).alias("step"),
            F.when(t.rlike("^<[aA]") & (F.regexp_extract(t, _HREF, 1) != ""), _href_value(t)).alias(
                "href"
            ),
        ),
    )
    return F.filter(items, lambda i: (i["step"] != 0) | i["href"].isNotNull())


def hrefs_in_body(tags: Column | str) -> Column:
    """Raw hrefs of all links, in document order."""
    links = F.filter(as_col(tags), lambda i: i["step"] == 0)
    return F.transform(links, lambda i: i["href"])


def trimmed_hrefs(hrefs: Column | str) -> Column:
    return F.transform(as_col(hrefs), trim_space)


def _flat_nav_links(items: Column, kinds: Column) -> Column:
    """Links below navs that do not nest; ``kinds`` has one character per item.

    A link is inside when it follows a ``(`` with nothing but links between.
    """
    marked = F.split(F.regexp_replace(kinds, r"(?:(?<=\()|\G(?!^))a", "i"), "")
    inside = F.filter(
        F.zip_with(items, marked, lambda i, m: F.struct(i["href"].alias("href"), m.alias("mark"))),
        lambda p: p["mark"] == "i",
    )
    return F.transform(inside, lambda p: p["href"])


def hrefs_in_nav(tags: Column | str) -> Column:
    """Raw hrefs below each nav; a link in nested navs is listed once per nav."""

    def links(items: Column) -> Column:
        kinds = F.array_join(
            F.transform(
                items,
                lambda i: F.when(i["step"] == 1, "(").when(i["step"] == -1, ")").otherwise("a"),
            ),
            "",
        )
        return bind(
            kinds,
            lambda k: F.when(k.rlike(r"\([^)]*\("), _nested_nav_links(items)).when(
                k.contains("("), _flat_nav_links(items, k)
            ),
        )

    return F.coalesce(bind(as_col(tags), links), F.array().cast("array<string>"))


PIECE = 128  # tags


def _running_depth(steps: Column) -> Column:
    """Depth after each step (1, -1); a stray end does not go below zero.

    An appended array is a copied one, so the depths are put together in pieces.
    """
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(steps) / PIECE).cast("int")),
        lambda c: F.slice(steps, c * PIECE + 1, F.lit(PIECE)),
    )
    last = lambda array: F.element_at(array, F.lit(-1))

    def from_depth(piece: Column, depth: Column) -> Column:
        return F.aggregate(piece, F.array(depth), lambda acc, s: F.array_append(acc, F.greatest(F.lit(0), last(acc) + s)))

    done = F.aggregate(
        pieces, F.array(F.array(F.lit(0))), lambda acc, piece: F.array_append(acc, from_depth(piece, last(last(acc))))
    )
    # each piece begins with the depth before it
    rest = lambda array: F.slice(array, F.lit(2), F.size(array))
    return bind(done, lambda d: F.flatten(F.transform(rest(d), rest)))


def _nested_nav_links(items: Column) -> Column:
    """Work in proportion to the tags and the links listed, however deep navs lie."""
    hrefs = F.transform(F.filter(items, lambda i: i["step"] == 0), lambda i: i["href"])
    places = F.filter(
        F.transform(items, lambda i, p: F.struct(p.alias("at"), i["step"].alias("step"))),
        lambda n: n["step"] != 0,
    )
    # In front of the k-th nav tag stand k others, and else links.
    navs = F.transform(places, lambda n, k: F.struct((n["at"] - k).alias("links"), n["step"].alias("step"), k.alias("k")))
    depths = bind(F.transform(navs, lambda n: n["step"]), _running_depth)

    def by_level(after: Column) -> Column:
        # A start tag and its end tag have one level, and follow each other there.
        before = F.concat(F.array(F.lit(0)), after)
        marks = F.zip_with(
            navs,
            F.arrays_zip(before.alias("b"), after.alias("a")),
            lambda n, d: F.struct(
                F.when(n["step"] == 1, d["a"]).otherwise(d["b"]).alias("level"), n["k"].alias("k"), n["step"], n["links"]
            ),
        )
        return F.sort_array(F.filter(marks, lambda m: m["k"].isNotNull() & (m["level"] > 0)))

    def spans(marks: Column) -> Column:
        following = F.concat(F.slice(marks, F.lit(2), F.size(marks)), F.slice(marks, F.lit(1), F.lit(0)))
        pairs = F.zip_with(
            marks,
            following,
            lambda m, f: F.struct(
                m["k"].alias("k"), m["step"].alias("step"), m["links"].alias("first"),
                F.when(f["level"] == m["level"], f["links"]).alias("end"),
            ),
        )
        return F.sort_array(F.filter(pairs, lambda p: p["step"] == 1))

    def listed(opened: Column, links: Column) -> Column:
        inside = lambda p: F.slice(links, p["first"] + 1, F.coalesce(p["end"], F.size(links)) - p["first"])
        return F.flatten(F.transform(opened, inside))

    return bind(
        hrefs,
        lambda links: bind(
            depths,
            lambda after: bind(by_level(after), lambda marks: bind(spans(marks), lambda opened: listed(opened, links))),
        ),
    )
