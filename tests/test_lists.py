import csv
import io
import random

import pytest

from dialmesh.sources import lists


def write(folder, name, text):
    path = folder / name
    path.write_bytes(text.encode())
    return str(path)


def good(result, *columns):
    return [tuple(r) for r in result.rows.orderBy("file", "line_index").select(*columns).collect()]


def bad(result):
    rows = result.rejects.orderBy("file", "line_index").collect()
    return [(r["line_index"], r["line"], r["error"]) for r in rows]


def errors(result):
    return [r["error"] for r in result.files.orderBy("file").collect()]


def test_domains(spark, tmp_path):
    path = write(tmp_path, "a.csv", "domain\n\tone.example\r\n\thttp://two.example/x\r\n\t https://three.example")
    out = lists.read_domains(spark, path)
    assert good(out, "line_index", "url", "scheme", "hostname") == [
        (1, "https://one.example", "https", "one.example"),
        (2, "http://two.example/x", "http", "two.example"),
        (3, "https://three.example", "https", "three.example"),
    ]
    assert bad(out) == [] and errors(out) == [None]
    assert out.failfast() is out


def test_bad_domain_lines_keep_their_index(spark, tmp_path):
    path = write(tmp_path, "a.csv", " domain \n\tone.example\n\tbad right here\n\n\ttwo.example\n\tftp://x.example\n")
    out = lists.read_domains(spark, path)
    assert good(out, "line_index", "hostname") == [(1, "one.example"), (4, "two.example")]
    assert bad(out) == [(2, "bad right here", "invalid_url"), (5, "ftp://x.example", "invalid_scheme")]
    with pytest.raises(lists.ListError) as error:
        lists.read_domains(spark, path, mode="failfast")
    assert [r["line_index"] for r in error.value.lines] == [2, 5]


def test_states_of_files(spark, tmp_path):
    write(tmp_path, "a.csv", "")
    write(tmp_path, "b.csv", "first, last\nx.example\n")
    write(tmp_path, "c.csv", "domain\n\n  \n")
    write(tmp_path, "d é%2F.csv", "domain\nbad line\n")
    write(tmp_path, "e.csv", "domain\nx.example\n")
    out = lists.read_domains(spark, str(tmp_path))
    assert errors(out) == ["empty_csv", "invalid_header", "empty_csv", None, None]
    assert good(out, "hostname") == [("x.example",)]
    assert bad(out) == [(1, "bad line", "invalid_url")]


def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


@pytest.fixture
def splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: small_splits(spark, size)
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("text, code", [("", "empty_csv"), ("x\ny\n", "invalid_header"), ("domain\n", "empty_csv")])
def test_failfast_on_whole_files(spark, tmp_path, text, code):
    path = write(tmp_path, "a.csv", text)
    with pytest.raises(lists.ListError) as error:
        lists.read_domains(spark, path, mode="failfast")
    assert error.value.code == code


def test_report_is_short_and_rejects_are_whole(spark, tmp_path):
    path = write(tmp_path, "a.csv", "domain\n" + "".join(f"bad {i}\n" for i in range(25)))
    out = lists.read_domains(spark, path)
    assert out.report().count() == 20 and out.rejects.count() == 25
    assert [r["line_index"] for r in out.report().collect()] == list(range(1, 21))


def test_line_numbers_across_splits(spark, tmp_path, splits):
    """A file cut into many splits numbers its lines as if read at once."""
    lines = ["domain"] + [("x" * (i % 90)) + f"h{i}.example" if i % 7 else "" for i in range(1, 3000)]
    write(tmp_path, "a.csv", "\r\n".join(lines))
    write(tmp_path, "b.csv", "\n".join(lines) + "\n")
    splits("4k")
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    out = lists.read_domains(spark, str(tmp_path))
    splits("1m")  # a later use may cut the files in another way
    want = [(i, line) for i, line in enumerate(lines) if i and line]
    assert good(out, "line_index", "hostname") == want + want


HEADER = "domain,company_commercial_name,company_legal_name,company_all_available_names\n"


def companies(result):
    return good(result, "line_index", "id", "commercial_name", "legal_name", "all_available_names")


def test_companies(spark, tmp_path):
    path = write(tmp_path, "a.csv", HEADER
                 + "\tzen.example,City Zen,CITY ZEN INC.,City Zen | Zen | CITY ZEN INC.\n"
                 + "glass.example, Glass Works , ,Glass Works\n"
                 + 'q.example,"Q, ""the"" shop",Q,"a|b"\n'
                 + "e.example,E,,\n")
    assert companies(lists.read_companies(spark, path)) == [
        (1, "zen.example", "City Zen", "CITY ZEN INC.", ["City Zen", "Zen", "CITY ZEN INC."]),
        (2, "glass.example", "Glass Works", "", ["Glass Works"]),
        (3, "q.example", 'Q, "the" shop', "Q", ["a", "b"]),
        (4, "e.example", "E", "", [""]),
    ]


def test_company_columns_in_any_order(spark, tmp_path):
    write(tmp_path, "a.csv", "company_legal_name,domain,company_all_available_names,company_commercial_name\n"
          "L,zen.example,a|b,C\n")
    write(tmp_path, "b.csv", HEADER + "two.example,C,L,a\n")
    write(tmp_path, "c.csv", "domain,company_commercial_name\nx.example,C\n")
    write(tmp_path, "d.csv", "domain,domain,company_legal_name,company_all_available_names\nx.example,a,b,c\n")
    out = lists.read_companies(spark, str(tmp_path))
    assert companies(out) == [(1, "zen.example", "C", "L", ["a", "b"]), (1, "two.example", "C", "L", ["a"])]
    assert errors(out) == [None, None, "invalid_header", "invalid_header"]


def test_bad_company_lines(spark, tmp_path):
    path = write(tmp_path, "a.csv", HEADER
                 + "zen.example,Z,Z,Z\n"
                 + "\t\tmany.example,one, two, three, four, five\n"
                 + "m.example,M,,M\n"
                 + "\n"
                 + "bad url,T,,T | T\n"
                 + "few.example,F\n"
                 + 'stray.example,a"b,,c\n'
                 + " \n"
                 + "last.example, X, X Y, x | y z")
    out = lists.read_companies(spark, path)
    assert [r[:2] for r in companies(out)] == [(1, "zen.example"), (3, "m.example"), (8, "last.example")]
    assert bad(out) == [
        (2, "\t\tmany.example,one, two, three, four, five", "wrong_number_of_fields"),
        (4, "bad url", "invalid_url"),
        (5, "few.example,F", "wrong_number_of_fields"),
        (6, 'stray.example,a"b,,c', "parse_error"),
        (7, " ", "wrong_number_of_fields"),
    ]


def test_record_that_is_never_closed(spark, tmp_path):
    path = write(tmp_path, "a.csv", HEADER + 'a.example,A,,A\nopen.example,"a,,c\nb.example,B,,B\n\nc.example,C,,C\n')
    out = lists.read_companies(spark, path)
    assert [r[:2] for r in companies(out)] == [(1, "a.example"), (3, "b.example"), (4, "c.example")]
    assert bad(out) == [(2, 'open.example,"a,,c', "parse_error")]
    assert errors(out) == ["parse_error"]


def test_no_line_is_lost_across_splits(spark, tmp_path, splits):
    """Header, rows, rejects and blank lines make up the file, wherever a quote stays open."""
    for at, name in ((3, "a.csv"), (250, "b.csv"), (499, "c.csv")):
        lines = [f"h{i}.example,N{i},,x" if i % 9 else "" for i in range(500)]
        lines[at] = f'h{at}.example,"N,,x'
        lines[2] = 'q.example,"in, quotes",,x'
        write(tmp_path, name, HEADER + "\n".join(lines) + "\n")
    splits("700")
    out = lists.read_companies(spark, str(tmp_path))
    blank = sum(i % 9 == 0 for i in range(500))
    counts = [r.asDict() for r in out.files.orderBy("file").collect()]
    for at, row in zip((3, 250, 499), counts):
        whole = 500 - blank + (at % 9 == 0)
        assert (row["good_rows"], row["rejected_rows"], row["error"]) == (whole - 1, 1, "parse_error")
    found = out.rows.unionByName(out.rejects, allowMissingColumns=True).select("file", "line_index")
    assert found.distinct().count() == found.count()


def test_badly_quoted_header(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'domain,"company\n' + "a.example,A,,A\n")
    assert errors(lists.read_companies(spark, path)) == ["parse_error"]


def test_quoted_line_breaks_across_splits(spark, tmp_path, splits):
    """Records with line breaks, in splits of a few hundred bytes, as a CSV reader sees them."""
    rng = random.Random(5)
    bits = ["a", "B c", "\n", "\n\n", '"', ",", "é", "|", " "]
    rows = [
        [f"h{i}.example"] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 7))) for _ in range(3)]
        for i in range(400)
    ]
    text = io.StringIO()
    writer = csv.writer(text, lineterminator="\n")
    for row in rows:
        writer.writerow(row)
        text.write("\n" * (rng.random() < 0.1))
    for name in ("a.csv", "b.csv"):
        write(tmp_path, name, HEADER + text.getvalue())
    write(tmp_path, "c.csv", HEADER + "plain.example,P,,P\n")
    splits("400")
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    out = lists.read_companies(spark, str(tmp_path))
    assert bad(out) == []
    want = [(i + 1, r[0], r[1].strip(), r[2].strip(), [n.strip() for n in r[3].split("|")]) for i, r in enumerate(rows)]
    assert companies(out) == want + want + [(1, "plain.example", "P", "", ["P"])]


def test_fields_against_the_csv_module(spark, column):
    cells = ["", "a", " b ", "x,y", 'say "hi"', '"', "é|ü", ",", '""']
    rows = [[a, b, a + b] for a in cells for b in cells]
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(rows)
    assert column(text.getvalue().splitlines(), lambda c: lists.csv_fields(__import__("pyspark").sql.functions.col(c))) == rows
