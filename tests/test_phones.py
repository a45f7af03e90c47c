import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dialmesh.functions import phones
from dialmesh.operators import phones as ops

PLAIN = re.compile(
    r"(\+[0-9]{1,2}[\t\n\f\r ])?[\t\n\f\r .-]*\(?[0-9]{3}\)?[\t\n\f\r .-]*[0-9]{3}[\t\n\f\r .-]*[0-9]{4}"
)
WORD = re.compile(rb"(?i)(?<![0-9A-Za-z_])(phone|telephone)(?![0-9A-Za-z_])")


def by_hand(text: str) -> list[tuple[str, int]]:
    found = []
    for match in PLAIN.finditer(text):
        before = text[: match.start()].encode()[-12:]
        found.append((match.group().strip("\t\n\x0b\f\r \x85\xa0"), 1 if WORD.search(before) else 0))
    return found


TEXTS = {
    "Phone: +1 210-212-2111": [("+1 210-212-2111", 1)],
    "Telephone: 211-210-2011": [("211-210-2011", 1)],
    " +1 210-212-2111": [("+1 210-212-2111", 0)],
    "a 210.212.2115 b\nphone\n+1 210 212 2118 x": [("210.212.2115", 0), ("+1 210 212 2118", 1)],
    "Phone number of the shop: 541-754-3010": [("541-754-3010", 0)],
    "ééphone: 541-754-3010": [("541-754-3010", 1)],
    "megaphone abcde: 541-754-3010": [("541-754-3010", 1)],
    "microphone: 541-754-3010": [("541-754-3010", 0)],
    "phone_ 541-754-3010": [("541-754-3010", 0)],
    "4785380592391139": [("4785380592", 0)],
    "see ..541 754 3010": [("..541 754 3010", 0)],
    "no number 123-45": [],
    "": [],
    "phone 5417543010phone 5417543011": [("5417543010", 1), ("5417543011", 0)],
    "+12 541-754-3010 +123 541-754-3010": [("+12 541-754-3010", 0), ("541-754-3010", 0)],
}


def test_match_phones(column):
    out = column(TEXTS, phones.match_phones)
    assert [[tuple(p) for p in r] for r in out] == list(TEXTS.values())
    assert [by_hand(t) for t in TEXTS] == list(TEXTS.values())


def test_long_separator_runs_are_linear(column):
    text = "-" * 200_000 + " 541" + " " * 200_000 + "754.3010 " + "x" * 1000
    (row,) = column([text], phones.match_phones)
    assert len(row) == 1 and row[0]["number"].startswith("---")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(
            st.sampled_from(
                ["5", "41", "754", "3010", "5417543010", "(", ")", "-", ".", " ", "\n", "+1 ", "+12 ",
                 "phone", "Telephone", "tele", "é", "x", "_", ":", "\u000b"]
            ),
            max_size=24,
        ).map("".join),
        min_size=40,
        max_size=40,
    )
)
def test_match_phones_against_plain_scan(column, texts):
    out = column(texts, phones.match_phones)
    assert [[tuple(p) for p in r] for r in out] == [by_hand(t) for t in texts]


VALID = {
    "541-754-3010 ext 4": "+1 541-754-3010 ext. 4",
    "541-754-3010;ext=12": "+1 541-754-3010 ext. 12",
    "(541) 754-3010 x7": "+1 541-754-3010 ext. 7",
    "(582) 754-3010": "+1 582-754-3010",
    "826.754.3010": "+1 826-754-3010",
    "+1 327 754 3010": "+1 327-754-3010",
    "(541) 754-3010": "+1 541-754-3010",
    "+1 541 754-3010": "+1 541-754-3010",
    "541.754.3010": "+1 541-754-3010",
    "5417543010": "+1 541-754-3010",
    "15417543010": "+1 541-754-3010",
    "+15417543010": "+1 541-754-3010",
    "..541.754.3010": "+1 541-754-3010",
    "888-999-0000": "+1 888-999-0000",
    "866-666-6666": "+1 866-666-6666",
    "458-588-0264": "+1 458-588-0264",
    " 416/555-0100": "+1 416-555-0100",
}
INVALID = {
    "(555) 555-5555": "invalid_number",
    "+1 555-555-5555": "invalid_number",
    "5555555555": "invalid_number",
    "123213451234531245": "invalid_number",
    "1635271811": "invalid_number",
    "666 888 0000": "invalid_number",
    "541-154-3010": "invalid_number",
    "211-555-0100": "invalid_number",
    "call me": "invalid_number",
    "ext. 12": "invalid_number",
    "635 271 8110": "invalid_number",
    "": "invalid_number",
    "+44 20 7946 0958": "unsupported_country",
    "+5417543010": "unsupported_country",
}


def test_validate_phone(column):
    assert [r["number"] for r in column(VALID, phones.validate_phone)] == list(VALID.values())
    out = column(INVALID, phones.validate_phone)
    assert [r["error"] for r in out] == list(INVALID.values())
    assert all(r["number"] is None for r in out)


def test_area_codes_can_be_replaced(column):
    out = column(["541-754-3010", "212-754-3010"], lambda c: phones.validate_phone(c, ["212"]))
    assert [r["number"] for r in out] == [None, "+1 212-754-3010"]


def test_area_code_rule():
    codes = phones.assigned_area_codes()
    assert len(codes) == len(set(codes)) and codes == sorted(codes)
    assert not any(c[1] == "9" or c.endswith("11") or c[:2] in ("37", "96") for c in codes)
    for code in ("201", "212", "416", "541", "787", "800", "876", "900", "989"):
        assert code in codes
    for code in ("200", "222", "555", "666", "976", "999"):
        assert code not in codes


def _rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_rejects_keep_their_place(spark):
    given = ["(541) 754-3010", "(555) 555-5555", "5417543012", "541.754.3013", "not a number"]
    df = spark.createDataFrame([("p", i, n, i % 3) for i, n in enumerate(given)],
                               "page string, pos int, number string, confidence int")
    good = ops.valid_phones(df).select("pos", "number", "confidence")
    assert _rows(good, "pos") == [
        (0, "+1 541-754-3010", 0), (2, "+1 541-754-3012", 2), (3, "+1 541-754-3013", 0)]
    assert _rows(ops.phone_rejects(df, ["page"]), "idx") == [
        ("p", 1, "(555) 555-5555", "invalid_number"), ("p", 4, "not a number", "invalid_number")]


def test_dedup_keeps_order_and_best_confidence(spark):
    given = [("a", 0), ("c", 0), ("b", 0), ("a", 2), ("b", 1), ("c", 0), ("a", 0)]
    df = spark.createDataFrame([("s", i, n, c) for i, (n, c) in enumerate(given)],
                               "scope string, pos int, number string, confidence int")
    out = ops.dedup_phones(df, ["scope"], ["pos"])
    assert _rows(out.select("number", "confidence", "pos"), "pos") == [("a", 2, 0), ("c", 0, 1), ("b", 1, 2)]


def test_page_phones_raw_and_clean(spark):
    body = (
        "<body><p>Call (503) 575-7321 or <b>666 888 1000</b></p><td>(503) 575 7321</td>"
        "<a href='tel:+15035757321'>a</a><a href='tel: 5035757321 '>b</a>"
        "<a href='TEL:1'>no</a><a href=tel:888-999-0000>c</a></body>"
    )
    pages = spark.createDataFrame([("u", body)], "url string, body string")
    raw = ops.page_phones(pages, ["url"])
    assert _rows(raw.select("pos", "number", "confidence"), "pos") == [
        (0, "(503) 575-7321", 0), (1, "666 888 1000", 0), (2, "(503) 575 7321", 0),
        (3, "+15035757321", 2), (4, "5035757321", 2), (5, "888-999-0000", 2)]
    clean = ops.label_phones(ops.page_phones(pages, ["url"], raw=False))
    assert _rows(clean.select("pos", "number", "label"), "pos") == [
        (0, "+1 503-575-7321", 'a[href="tel:< phone number >"]'),
        (5, "+1 888-999-0000", 'a[href="tel:< phone number >"]')]


def test_labels(spark):
    df = spark.createDataFrame([(c,) for c in (0, 1, 2, 7)], "confidence int")
    assert [r["label"] for r in ops.label_phones(df).orderBy("confidence").collect()] == [
        "regex match", "regex match with 'phone' prefix", 'a[href="tel:< phone number >"]', "unknown"]
