"""North American phone numbers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITE_SPACE, as_col, bind, trim_space

INVALID_NUMBER = "invalid_number"
UNSUPPORTED_COUNTRY = "unsupported_country"

# Confidence levels, weakest first (fixed values).
REGEX_MATCH = 0
REGEX_MATCH_AFTER_WORD = 1
TEL_LINK = 2
CONFIDENCE_LABELS = {
    REGEX_MATCH: "regex match",
    REGEX_MATCH_AFTER_WORD: "regex match with 'phone' prefix",
    TEL_LINK: 'a[href="tel:< phone number >"]',
}

# Fixed value: the plain pattern is (\+\d{1,2}\s)?[\s.-]*\(?\d{3}\)?[\s.-]*\d{3}[\s.-]*\d{4} with
# \s = [\t\n\f\r ].  A match never starts inside a run of separators, so the
# lookbehind below changes no result but keeps long runs linear.
_BLANK = r"\t\n\f\r "
_SEPARATOR = rf"[{_BLANK}.\-]"
PHONE_PATTERN = (
    rf"(?=[+(0-9{_BLANK}.\-])"  # quick miss on letters
    rf"(?:\+[0-9]{{1,2}}[{_BLANK}]{_SEPARATOR}*+|(?<!{_SEPARATOR}){_SEPARATOR}*+)"
    rf"\(?[0-9]{{3}}\)?{_SEPARATOR}*+[0-9]{{3}}{_SEPARATOR}*+[0-9]{{4}}"
)

WINDOW_BYTES = 12
_PHONE_WORD = r"(?i)(?<![0-9A-Za-z_])(?:phone|telephone)(?![0-9A-Za-z_])"

# Unassigned three-digit codes of the North American numbering plan among those
# that its format rule admits (fixed values, public numbering plan as of 2025).  A code in
# doubt counts as assigned.
UNASSIGNED_AREA_CODES = """
221 230 232 237 238 241 243 245 247 258 259 261 265 271 275 278 280 282 285 286 287
328 335 338 342 348 349 356 358 359 362 381 383 384 389
420 421 426 427 429 439 446 449 451 452 453 454 456 459 461 462 467 476 481
482 485 486 487 489
532 535 536 537 538 542 543 545 546 547 549 550 552 553 554 556 558 560 565 568 569 576
578 583 589
625 627 632 634 635 637 638 642 643 648 652 653 654 663 665 668 673 674 675 676 685 687
723 735 736 739 741 745 746 749 750 751 752 756 759 761 764 768 776 783 789
823 824 827 834 836 841 842 846 852 853 871 874 875 879 880 881 882 883 884 885
886 887 889
921 923 926 927 932 935 946 950 953 957 958 974 976 981 982 987
""".split()

# Codes with a repeated digit are kept for services; these are in use (fixed values).
SERVICE_AREA_CODES = {
    "toll_free": "800 833 844 855 866 877 888".split(),
    "premium": ["900"],
    "personal": "500 522 533 544 566 577 588".split(),
    "other": "600 622 633 644 655 677 688".split(),
}


def assigned_area_codes() -> list[str]:
    """All codes in use: the plan's format rule less the unassigned codes.

    Format rule: first digit 2-9, no 9 in the middle, no N11, none of the blocks
    37X and 96X; a repeated last digit marks a service code.
    """
    service = {code for codes in SERVICE_AREA_CODES.values() for code in codes}
    unassigned = set(UNASSIGNED_AREA_CODES)
    codes = []
    for number in range(200, 1000):
        code = str(number)
        if code[1] == "9" or code[1:] == "11" or code[:2] in ("37", "96"):
            continue
        if code[1] == code[2]:
            if code in service:
                codes.append(code)
        elif code not in unassigned:
            codes.append(code)
    return codes


def phone_matches(text: Column | str) -> Column:
    """All non-overlapping matches of the US pattern, untrimmed, in text order."""
    return F.regexp_extract_all(as_col(text), F.lit(PHONE_PATTERN), F.lit(0))


def match_phones(text: Column | str) -> Column:
    """``array<struct<number, confidence>>`` of the matches in a text.

    A match is at least ten bytes long, so the twelve bytes in front of it lie in
    the gap before it, the match before that, and the gap before that match.
    The window is cut in bytes and read as Latin-1, so no byte is lost.
    """

    def with_confidence(found: Column, gaps: Column) -> Column:
        def one(match: Column, i: Column) -> Column:
            before = F.concat(
                F.when(
                    i > 0,
                    F.concat(
                        F.when(i > 1, F.get(found, i - 2)).otherwise(""),
                        F.right(F.get(gaps, i - 1), F.lit(WINDOW_BYTES)),
                        F.get(found, i - 1),
                    ),
                ).otherwise(""),
                F.right(F.get(gaps, i), F.lit(WINDOW_BYTES)),
            )
            window = F.decode(
                F.substring(F.encode(before, "UTF-8"), -WINDOW_BYTES, WINDOW_BYTES), "ISO-8859-1"
            )
            level = F.when(window.rlike(_PHONE_WORD), REGEX_MATCH_AFTER_WORD).otherwise(REGEX_MATCH)
            return F.struct(trim_space(match).alias("number"), level.alias("confidence"))

        return F.transform(found, one)

    def in_text(body: Column) -> Column:
        # Every match ends in four digits; most texts have none and need no full scan.
        found = bind(
            phone_matches(body),
            lambda ms: F.when(
                F.size(ms) > 0,
                bind(F.split(body, PHONE_PATTERN, -1), lambda gaps: with_confidence(ms, gaps)),
            ),
        )
        return F.when(body.rlike("[0-9]{4}"), found)

    empty = F.array().cast("array<struct<number:string,confidence:int>>")
    return F.coalesce(bind(as_col(text), in_text), empty)


def tel_phones(hrefs: Column | str) -> Column:
    """Numbers of ``tel:`` links (case-sensitive prefix) among raw hrefs."""
    tel = F.filter(as_col(hrefs), lambda h: h.startswith("tel:"))
    return F.transform(
        tel,
        lambda h: F.struct(
            trim_space(F.substr(h, F.lit(5))).alias("number"),
            F.lit(TEL_LINK).alias("confidence"),
        ),
    )


# An extension as tel links and texts write it: ";ext=12", "ext. 12", "x12", "#12".
_EXTENSION = r"(?i)(?<=[0-9)])[\s,;]*(?:;ext=|extension|extn?\.?|x|#)[\s:.]*([0-9]{1,7})#?$"


def validate_phone(number: Column | str, area_codes: list[str] | None = None) -> Column:
    """``struct<number, error>``: international format, or the reason of rejection.

    ``area_codes`` replaces the built-in list of codes in use.  An extension is kept, as
    ``+1 AAA-BBB-CCCC ext. N``.
    """
    codes = assigned_area_codes() if area_codes is None else list(area_codes)

    def parts(whole: Column) -> Column:
        extension = F.regexp_extract(whole, _EXTENSION, 1)
        text = F.regexp_replace(whole, _EXTENSION, "")
        digits = F.regexp_replace(text, r"[^0-9]", "")
        clean = text.rlike(rf"^[^0-9+A-Za-z]*+\+?+[0-9{WHITE_SPACE}.()\[\]/~\-\u2010-\u2015]++$")
        # A plus sign announces a country code, which must be 1.
        foreign = text.rlike(r"^[^0-9+A-Za-z]*+\+") & ~digits.startswith("1")
        return F.struct(
            F.regexp_replace(digits, r"^1", "").alias("national"),
            clean.alias("clean"),
            (foreign & (digits != "")).alias("foreign"),
            F.when(extension != "", F.concat(F.lit(" ext. "), extension)).otherwise("").alias("extension"),
        )

    def checked(p: Column) -> Column:
        shaped = p["national"].rlike(r"^[2-9][0-9]{2}[2-9][0-9]{6}$")
        # One literal instead of hundreds keeps the plan small.
        assigned = F.find_in_set(F.substring(p["national"], 1, 3), F.lit(",".join(codes))) > 0
        return F.when(
            p["clean"] & shaped & ~p["foreign"] & assigned,
            F.concat(format_international(p["national"]), p["extension"]),
        )

    def result(p: Column) -> Column:
        return bind(
            checked(p),
            lambda good: F.struct(
                good.alias("number"),
                F.when(good.isNotNull(), F.lit(None).cast("string"))
                .when(p["clean"] & p["foreign"], F.lit(UNSUPPORTED_COUNTRY))
                .otherwise(F.lit(INVALID_NUMBER))
                .alias("error"),
            ),
        )

    return bind(bind(trim_space(number), parts), result)


def format_international(ten_digits: Column | str) -> Column:
    """``+1 AAA-BBB-CCCC`` of a ten-digit national number."""
    return F.regexp_replace(as_col(ten_digits), r"^(...)(...)(....)$", "+1 $1-$2-$3")


def confidence_label(confidence: Column | str) -> Column:
    level = as_col(confidence)
    label = F.lit("unknown")
    for value, text in CONFIDENCE_LABELS.items():
        label = F.when(level == value, F.lit(text)).otherwise(label)
    return label
