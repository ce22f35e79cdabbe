import hashlib
import re

from pyspark.sql import functions as F

from leafmill.functions import paths, text

AWKWARD = [
    None,
    "",
    "   ",
    "plain",
    "ééé",
    " a b ",
    "\x1c x \x1f",
    "aéèb \U0001f600 c",
    "\n\n\ta\n",
    "xé",
]


def _column(spark, values, expression):
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in frame.select(expression(F.col("v"))).collect()]


def test_clean_text_equals_python(spark):
    def expected(value):
        return "" if not value else re.sub(r"[^\x00-\x7F]+", " ", value).strip()

    assert _column(spark, AWKWARD, text.clean_text) == [expected(v) for v in AWKWARD]


def test_strip_equals_python(spark):
    values = [v for v in AWKWARD if v is not None] + [f"{c}a{c}" for c in text.PYTHON_WHITESPACE]
    assert _column(spark, values, text.strip) == [v.strip() for v in values]
    assert set(text.PYTHON_WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_document_id(spark):
    rows = [("ab", "c", None), ("a", "bc", None), (None, None, None), ("é", "", "x")]
    frame = spark.createDataFrame(rows, "a string, b string, c string")
    ids = [r[0] for r in frame.select(text.document_id(*(F.col(c) for c in "abc"))).collect()]
    assert ids == [hashlib.sha256(f"{a}{b}{c}".encode()).hexdigest() for a, b, c in rows]
    assert ids[0] == ids[1]
    apart = frame.select(text.document_id(F.col("a"), F.col("b"), sep="\x1f")).collect()
    assert apart[0][0] != apart[1][0]


def test_token_count(spark):
    values = [None, "", "a b", "it's 3.14!", " \x0b\t ", "été ok", "\U0001f600\U0001f600"]
    expected = [len(re.findall(r"[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\x0b\x0c\r]", v or "")) for v in values]
    assert _column(spark, values, text.token_count) == expected


def test_path_fields(spark):
    values = [
        "raw/item/cat/author/title.pdf",
        "a.b.pdf",
        "one/two",
        "x/y/z/w/noext",
        "x/y/z/w/a.b.pdf",
        "",
        None,
    ]
    rows = _column(spark, values, paths.path_fields)
    got = [tuple(r) if r else None for r in rows]
    assert got[0] == ("item", "cat", "author", "title", "pdf")
    assert got[1] == (None, None, None, "a", "b")
    assert got[2] == (None, None, "one", "two", None)
    assert got[3] == ("y", "z", "w", "noext", None)
    assert got[4] == ("y", "z", "w", "a", "b")


def test_path_tail(spark):
    values = ["../a/b.pdf", "a/b", "x", "..", "a/../b/c"]
    expected = [v.replace("..", "").split("/")[1:] for v in values]
    assert _column(spark, values, paths.path_tail) == expected


def test_suffix_and_substring(spark):
    values = ["a.pdf", "a.PDF", "a.pdf.txt", "pdf", None]
    assert _column(spark, values, lambda c: paths.has_suffix(c, ".pdf")) == [
        True, False, False, False, None,
    ]
    assert _column(spark, values, lambda c: paths.has_substring(c, ".pdf")) == [
        True, False, True, False, None,
    ]
