import datetime

import pytest
from pyspark.sql import functions as F

from goldkeel.functions import text
from goldkeel.functions.dates import effective_date
from goldkeel.functions.ids import content_id
from goldkeel.functions.labels import npi_status, retrieval_type


def evaluate(spark, values, expression, types="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {types}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_address_lines_keep_blank_after_line_one(spark):
    df = spark.createDataFrame([("1 Main", None), (None, "Suite 2"), (None, None), ("1 Main", "Suite 2")], "a string, b string")
    got = [r[0] for r in df.select(text.address_lines(F.col("a"), F.col("b"))).collect()]
    assert got == ["1 Main ", "Suite 2", "", "1 Main Suite 2"]


def test_piped_addresses_differ_in_null_handling(spark):
    df = spark.createDataFrame([("1 Main", None, "X", None, "08080")], "a string, b string, c string, s string, z string")
    columns = [F.col(c) for c in "abcsz"]
    assert df.select(text.piped_address(*columns)).first()[0] == "1 Main  | X |  | 08080"
    assert df.select(text.piped_full_address(F.col("a"), F.col("c"), F.col("s"), F.col("z"))).first()[0] is None
    assert df.select(text.spaced_address(*columns)).first()[0] == "1 Main X 08080 "


def test_zip_gets_one_zero(spark):
    got = evaluate(spark, ["123", "8080", "08080", None, "123  "], text.fix_zip)
    assert got == ["0123", "08080", "08080", None, "0123  "]


def test_cleanse_phone(spark):
    values = [None, "12345", "8562628300", "(856) 262-8300", "none", "", "1-856-262-8300"]
    assert evaluate(spark, values, text.cleanse_phone) == [
        None, "12345", "8562628300", "8562628300", None, None, "18562628300",
    ]
    assert evaluate(spark, values, lambda c: text.cleanse_phone(c, strip_country=True))[-1] == "8562628300"


def test_display_phone(spark):
    values = ["8562628300", "12345", None, "1234567"]
    assert evaluate(spark, values, lambda c: text.display_phone(c, "0")) == [
        "(856)262-8300", "0", "0", "(123)456-7",
    ]


def test_comparison_ignores_case_and_trailing_blanks(spark):
    values = ["qap", "QAP  ", " QAP", None]
    assert evaluate(spark, values, lambda c: text.DEFAULT_RULES.equals(c, "QAP ")) == [True, True, False, None]
    assert evaluate(spark, values, lambda c: text.EXACT.equals(c, "QAP")) == [False, False, False, None]
    assert evaluate(spark, values, lambda c: text.DEFAULT_RULES.differs(c, "Qap")) == [False, False, True, None]
    assert evaluate(spark, ["Acme X", "ACME"], lambda c: text.DEFAULT_RULES.like(c, "acme%")) == [True, True]
    assert evaluate(spark, ["Acme X", "ACME"], lambda c: text.EXACT.like(c, "Acme%")) == [True, False]


def test_effective_date(spark):
    early, late = datetime.date(2017, 1, 1), datetime.date(2018, 1, 1)
    df = spark.createDataFrame(
        [(None, early), (late, early), (early, late), (late, None), (None, None)], "m date, c date"
    )
    got = [r[0] for r in df.select(effective_date(F.col("m"), F.col("c"))).collect()]
    assert got == [early, late, late, None, None]


@pytest.mark.parametrize(
    "name, label",
    [
        (None, "NullsOthers"),
        ("Client sFTP", "SFTP"),
        ("mailroom east", "Mail Room"),
        ("RINGCENTRAL", "Fax"),
        ("E Mail", "E-Mail"),
        ("BOX", "CopyService"),
        ("box ", "CopyService"),
        ("box 2", "Field"),
        ("KIDS CLINIC", "CopyService"),
        ("FTP by email", "SFTP"),
        ("J. Doe", "Field"),
        ("Replication", "Field"),
    ],
)
def test_retrieval_type(spark, name, label):
    folded = text.DEFAULT_RULES.folded
    assert evaluate(spark, [name], lambda c: retrieval_type(folded(c))) == [label]


def test_retrieval_type_by_exact_case(spark):
    got = evaluate(spark, ["sftp", "SFTP", "box"], lambda c: retrieval_type(c, text.EXACT))
    assert got == ["Field", "SFTP", "Field"]


def test_npi_status(spark):
    got = evaluate(spark, ["1", "2", "3", None], lambda c: npi_status(c, "No Record"))
    assert got == ["Individual", "Organization", "No Record", "No Record"]
    got = evaluate(spark, ["01", " 2 ", "x", ""], lambda c: npi_status(c, "No Record"))
    assert got == ["Individual", "Organization", "No Record", "No Record"]


def test_content_id(spark):
    import hashlib

    plain = "#$%^&a &^%$##$%^&&^%$#"
    df = spark.createDataFrame([("a ", None)], "a string, b string")
    parts = (F.col("a"), F.col("b"))
    assert df.select(content_id(*parts)).first()[0] == hashlib.md5(plain.encode()).hexdigest().upper()
    wide = df.select(content_id(*parts, encoding="UTF-16LE")).first()[0]
    assert wide == hashlib.md5(plain.encode("utf-16-le")).hexdigest().upper()
