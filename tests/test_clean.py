from obsframe.operators import clean
from tests.conftest import rows

RAW = [
    # source, dataset, code, name, entity, year, value, row_order
    (" WB ", "WDI", "NY.GDP", "gdp", None, "2020", "12.5", 1),
    ("WB", "WDI", "NY.GDP", "gdp", "nan", "2020", "13", 2),        # duplicate of row 1 (entity NULL)
    ("WB", "WDI", "NY.GDP", "gdp", "", "2021", "NA", 3),
    ("WB", "WDI", "NY.GDP", "gdp", "None", "2021", "7", 4),        # duplicate, first one was NA
    ("WB", "WDI", "NY.GDP", "gdp", "Peru", "1899", "1", 5),
    ("WB", "WDI", "NY.GDP", "gdp", "Peru", "1900", "NaN", 6),
    ("WB", "WDI", "NY.GDP", "gdp", "Peru", "2100", "abc", 7),
    ("WB", "WDI", "NY.GDP", "gdp", "Peru", "2101", "1", 8),
    ("WB", "WDI", "NY.GDP", "gdp", "Peru", "", "1", 9),
]
SCHEMA = "source string, dataset string, code string, name string, entity string, year string, value string, row_order int"


def test_type_long_tokens(spark):
    t = {r["row_order"]: r for r in clean.type_long(spark.createDataFrame(RAW, SCHEMA)).collect()}
    assert t[1]["source"] == "WB" and t[1]["value"] == 12.5
    assert t[2]["entity"] is None and t[3]["entity"] is None and t[4]["entity"] is None
    assert t[3]["value"] is None and t[6]["value"] is None and t[7]["value"] is None
    assert t[9]["year"] is None


def test_clean_long_keep_first_and_validity(spark):
    out = rows(clean.clean_long(spark.createDataFrame(RAW, SCHEMA)), "year", "entity")
    keys = [(r["entity"], r["year"], r["value"], r["is_missing"]) for r in out]
    assert keys == [("Peru", 1900, None, True), (None, 2020, 12.5, False), (None, 2021, None, True),
                    ("Peru", 2100, None, True)]


def test_dedup_is_idempotent(spark):
    c = clean.clean_long(spark.createDataFrame(RAW, SCHEMA))
    again = clean.dedup_first(c.withColumn("row_order", c.year), order_by="row_order")
    assert again.count() == c.count()


def test_run_counters(spark):
    r = clean.run_counters(spark.createDataFrame(RAW, SCHEMA)).collect()[0]
    assert (r.n_read, r.n_rejected_year, r.n_duplicates, r.n_final, r.n_missing) == (9, 3, 2, 4, 3)


def test_subject_scope_and_codes(spark):
    df = spark.createDataFrame([(None, "A.b"), ("Peru", "x"), ("France", "a.B")], "entity string, code string")
    assert clean.subject_scope(df, "Peru").count() == 2
    assert clean.code_filter(df, ["A.B"]).count() == 2
