import pytest
from pyspark.sql import functions as F

from lexloom.functions.celex import with_celex_components, with_doc_type_label, with_sector_label
from lexloom.functions.text import with_clean_text
from lexloom.schemas import DOC_TYPE_LABELS

# Ids and what they stand for.
CASES = [
    ("32014R0727", "3", 2014, "R", "Regulation"),
    ("31975R2481", "3", 1975, "R", "Regulation"),
    ("32010D0008", "3", 2010, "D", "Decision"),
    ("32003D0253(01)", "3", 2003, "D", "Decision"),
    ("32014L0024", "3", 2014, "L", "Directive"),
    ("32014Z0001", "3", 2014, "Z", "Other"),
    ("BAD", None, None, None, "Other"),
    ("", None, None, None, "Other"),
    ("3201", "3", None, None, "Other"),
    (None, None, None, None, "Other"),
]


def test_parsing_and_labels(spark):
    ids = spark.createDataFrame([(c[0],) for c in CASES], "celex_id string")
    parsed = ids.transform(with_celex_components).transform(with_doc_type_label)
    found = {tuple(r) for r in parsed.select("celex_id", "sector", "year", "doc_type", "doc_type_label").collect()}
    assert found == set(CASES)
    assert parsed.schema["year"].dataType.simpleString() == "int"


def test_every_type_letter_and_sector_label(spark):
    letters = spark.createDataFrame([(k,) for k in DOC_TYPE_LABELS], "doc_type string")
    assert {tuple(r) for r in with_doc_type_label(letters).collect()} == set(DOC_TYPE_LABELS.items())
    sectors = spark.createDataFrame([("3",), ("0",), (None,)], "sector string")
    assert {tuple(r) for r in with_sector_label(sectors).collect()} == {("3", "Legislation"), ("0", None), (None, None)}


HEADER = "1.7.2014 EN Official Journal of the European Union L 192/42\n"


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        (HEADER + "COMMISSION REGULATION\nBody", "COMMISSION REGULATION\nBody"),
        ("  \n" + HEADER + "Text", "Text"),
        ("Body\n" + HEADER + "Text", "Body\n" + HEADER + "Text"),
        ("First article.\n\n\n\nSecond article,\non two lines.", "First article.\n\nSecond article,\non two lines."),
        ("word1     word2\tword3", "word1 word2 word3"),
        ("\t a \t b \n", "a b"),
        ("a\n \n \nb", "a\n \n \nb"),
        ("a\r\n\r\n\r\nb", "a\r\n\r\n\r\nb"),
        (" a ", " a "),
        ("\x0b\f a \r\n", "a"),
        ("1.7.2014 EN Official Journal of the European Communities L 192/42\nText",) * 2,
        ("", ""),
        (None, None),
    ],
)
def test_cleaning(spark, raw, clean):
    df = spark.createDataFrame([("  Council Decision\n", raw)], "title string, text string")
    assert tuple(with_clean_text(df).first()) == ("Council Decision", clean)


def test_long_texts_are_cleaned_whole(spark):
    df = spark.range(1).select(F.lit("t").alias("title"), F.repeat(F.lit("ab  c\n\n\n"), 200_000).alias("text"))
    assert with_clean_text(df).select(F.length("text")).first()[0] == 200_000 * len("ab c\n\n") - 2
