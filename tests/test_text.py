import pytest
from pyspark.sql import functions as F

from quiremill.functions import quotes as Q
from quiremill.functions import text as T


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("heading", "section"),
    [("Methods", "methods"), ("2.1 Materials and Methods", "methods"), ("STAR★METHODS", "methods"), ("Results and Discussion:", "results"), ("IV. Discussion", "discussion"), ("Single-cell profiling of islets", None), ("Data availability statement", "data_availability"), ("x" * 130, None), (None, None)],
)
def test_section_of_heading(spark, heading, section):
    assert one(spark, T.section_of_heading(F.col("h")), h=heading) == section


def test_sec_type_wins(spark):
    df = spark.createDataFrame([("Findings", "methods"), ("Findings", "odd")], "h string, t string")
    assert [r.s for r in df.select(T.section_of_heading(F.col("h"), F.col("t")).alias("s")).collect()] == ["methods", "results"]


def test_glued_heading(spark):
    rest = "Overview of the experimental approach and of what was measured in it"
    x = one(spark, T.glued_heading(F.col("t")), t=f"Results {rest}")
    assert (x.section, x.heading, x.rest) == ("results", "Results", rest)
    assert one(spark, T.glued_heading(F.col("t")), t="Results of the assay were consistent with all that we had expected to see") is None
    assert one(spark, T.glued_heading(F.col("t")), t="Results Too short") is None


def test_heading_and_citation_looks(spark):
    df = spark.createDataFrame([("KEY RESOURCES",), ("Nuclei Isolation From Heart",), ("it was cold.",), ("the end of it all",)], "t string")
    assert [r.x for r in df.select(T.looks_like_heading(F.col("t")).alias("x")).collect()] == [True, True, False, False]
    df = spark.createDataFrame([("12. Smith J",), ("as shown (2019a)",), ("Lee et al",), ("plain prose",), (None,)], "t string")
    assert [r.x for r in df.select(T.looks_like_citation(F.col("t")).alias("x")).collect()] == [True, True, True, False, False]


def test_cells(spark):
    df = spark.createDataFrame([(" 1.5 ",), ("45 %",), ("1,000",), ("Yes",), ("2020-01-31",), ("inf",), ("  ",)], "c string")
    rows = df.select(T.clean_cell(F.col("c")).alias("c")).select("c", T.value_kind(F.col("c")).alias("k"), T.as_number(F.col("c")).alias("n")).collect()
    assert [r.k for r in rows] == ["number", "number", "text", "boolean", "date", "text", None]
    assert [r.n for r in rows] == [1.5, 45.0, None, None, None, None, None]


def test_doi(spark):
    assert one(spark, T.normalized_doi(F.col("d")), d="https://doi.org/10.1038/S41586-024-1.") == "10.1038/s41586-024-1"
    assert one(spark, T.doi_slug(F.col("d")), d="10.1016/j.cell(20)") == "10.1016_j.cell-20-"
    assert one(spark, T.cited_dois(F.col("t"), F.col("e")), t="see 10.1/no 10.1234/a, 10.1234/B. 10.1234/a", e="10.1234/b") == ["10.1234/a"]
    assert one(spark, T.mentions_doi(F.col("t"), F.col("d")), t="doi 10.1234/\nAB c", d="10.1234/abc")


def test_identity(spark):
    long = "filler words " * 30
    df = spark.createDataFrame([("tiny", "10.1/x", "t"), (long + "10.1234/x", "10.1234/x", "t"), (long + "plasticity islets", "10.1234/x", "Plasticity of islets"), (long, "10.1234/x", "Plasticity of islets")], "t string, d string, n string")
    assert [r.m for r in df.select(T.identity(F.col("t"), F.col("d"), F.col("n")).alias("i")).select("i.matched_on").toDF("m").collect()] == ["undecidable", "doi", "title", None]


def test_dehyphenated(spark):
    assert one(spark, T.dehyphenated(F.col("t")), t="recog-\nnise IL-\n6 and SARS-\nCoV") == "recognise IL-6 and SARS-CoV"


def test_quote_levels(spark):
    df = spark.createDataFrame([("a “b”", 'x a "b" y'), ("A-B c", "zz ab, C"), ("a b", "x a b"), ("  ", "x"), ("q", "x")], "q string, t string")
    assert [r.v for r in df.select(Q.cheap_verdict(F.col("q"), F.col("t")).alias("v")).collect()] == ["normalized", "loose", "exact", "empty_quote", None]
    assert Q.normalized_text("a–b “c”") == 'a-b "c"'
    quote = "".join(f"{i:02d}ab" for i in range(15))
    cover, run = Q.fuzzy_measures(quote, quote[:20] + "x" + quote[20:])
    assert cover == 1.0 and run >= 0.4
