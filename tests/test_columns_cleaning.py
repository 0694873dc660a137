from pyspark.sql import functions as F

from tabula.functions.codes import WEATHER_CODES, WEATHER_DEFAULT
from tabula.operators import cleaning, columns


def frame(spark):
    return spark.createDataFrame([(1, "a"), (2, ""), (None, None)], "n int, s string")


def test_map_codes_null_and_unknown_take_default(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "w int")
    out = columns.map_codes(df, "w", WEATHER_CODES, WEATHER_DEFAULT, out="label")
    got = {r.w: r.label for r in out.collect()}
    assert got == {1: "Clear", 2: "Mist", 3: "Light Rain-Snow", 4: "Heavy Rain", None: "Heavy Rain"}


def test_map_codes_stays_native(spark):
    df = spark.createDataFrame([(1,)], "w int")
    plan = columns.map_codes(df, "w", WEATHER_CODES, WEATHER_DEFAULT)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_blank_to_null_only_strings(spark):
    out = cleaning.blank_to_null(frame(spark)).collect()
    assert [tuple(r) for r in out] == [(1, "a"), (2, None), (None, None)]


def test_replace_value_is_a_value_not_null(spark):
    out = cleaning.replace_value(frame(spark), "", "null").collect()
    assert out[1].s == "null"


def test_drop_nulls(spark):
    df = frame(spark)
    assert cleaning.drop_nulls(df).count() == 2
    assert cleaning.drop_nulls(cleaning.blank_to_null(df)).count() == 1
    assert cleaning.drop_nulls(df, subset=["n"]).count() == 2


def test_null_report(spark):
    rep = {r.column_name: (r.nulls, r.rows, r.any_null) for r in cleaning.null_report(frame(spark)).collect()}
    assert rep == {"n": (1, 3, True), "s": (1, 3, True)}


def test_drop_missing_column_is_ignored(spark):
    assert columns.drop_columns(frame(spark), ["zzz", "s"]).columns == ["n"]


def test_roles_by_prefix_and_type(spark):
    df = spark.createDataFrame([(1, "A", "B", 1.0, 2.0, 3.0)], "id int, cat1 string, cat2 string, cont1 double, cont2 double, loss double")
    r = columns.infer_roles(df, cat_prefix="cat", cont_prefix="cont", label="loss", ids=["id"])
    assert r.categorical == ("cat1", "cat2") and r.numeric == ("cont1", "cont2")
    r2 = columns.infer_roles(df, label="loss", ids=["id"])
    assert r2.categorical == ("cat1", "cat2") and r2.numeric == ("cont1", "cont2")
    assert columns.select_where(df, lambda c: c.startswith("cont")).columns == ["cont1", "cont2"]


def test_null_report_takes_names_literally(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "`it's a.b` int, `back\\slash` int")
    got = {r.column_name: r.nulls for r in cleaning.null_report(df).collect()}
    assert got == {"it's a.b": 1, "back\\slash": 2}


def test_free_text_is_no_category(spark):
    from pyspark.sql import functions as F
    df = spark.range(500).select(F.concat(F.lit("text "), F.col("id")).alias("t"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"), "id")
    assert columns.infer_roles(df).categorical == ("t", "g")
    assert columns.infer_roles(df, max_distinct=50).categorical == ("g",)
