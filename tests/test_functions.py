import datetime as dt

from pyspark.sql import functions as F

from custofold import functions as fn


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def test_text(spark):
    null = F.lit(None).cast("string")
    got = one(
        spark,
        blank=fn.blank_default(null), kept=fn.blank_default(F.lit(" a")), number=fn.blank_default(F.lit(7)),
        trimmed=fn.clean(F.lit("  a b ")),
        na_null=fn.blank_to(null), na_blank=fn.blank_to(F.lit("  ")), untrimmed=fn.blank_to(F.lit(" x ")),
        joined=fn.code_concat(F.lit("a"), F.lit("b")), lost=fn.code_concat(F.lit("a"), null),
        shown=fn.value_if(F.lit(True), F.lit(" l ")), hidden=fn.value_if(F.lit(False), F.lit("l")),
        unknown=fn.value_if(null.isin("C"), F.lit("l")),
        second=fn.null_fallback(null, F.lit("b")), first=fn.null_fallback(F.lit(""), F.lit("b")),
        xml=fn.xml_text(F.lit("a&<b>")), xml_null=fn.xml_text(null),
    )
    assert got == {
        "blank": "", "kept": " a", "number": "7", "trimmed": "a b",
        "na_null": "Not Available", "na_blank": "Not Available", "untrimmed": " x ",
        "joined": "ab", "lost": None, "shown": "l", "hidden": None, "unknown": None,
        "second": "b", "first": "", "xml": "a&amp;&lt;b&gt;", "xml_null": "",
    }


def test_full_name_keeps_the_space_of_empty_parts(spark):
    null = F.lit(None).cast("string")
    got = one(spark, a=fn.full_name(F.lit(" Mr "), null, F.lit("  "), F.lit("Fox ")), b=fn.full_name(null, F.lit(" ")))
    assert got == {"a": "Mr   Fox", "b": ""}


def test_has_value_is_never_null(spark):
    got = one(
        spark, null=fn.has_value(F.lit(None).cast("string")), blank=fn.has_value(F.lit(" ")), text=fn.has_value(F.lit("x"))
    )
    assert got == {"null": False, "blank": False, "text": True}


def test_time(spark):
    got = one(
        spark,
        plain=fn.parse_ts(F.lit("2020-02-03T04:05:06")),
        fraction=fn.parse_ts(F.lit("2020-02-03T04:05:06.5")),
        bad=fn.parse_ts(F.lit("yesterday")),
        day=fn.default_today(F.lit(None).cast("string"), dt.date(2024, 1, 2)),
        blank=fn.default_today(F.lit(""), dt.date(2024, 1, 2)),
        clock=fn.default_today(F.lit(None).cast("string")).isNotNull(),
    )
    assert got["plain"] == dt.datetime(2020, 2, 3, 4, 5, 6)
    assert got["fraction"].microsecond == 500000
    assert (got["bad"], got["day"], got["blank"], got["clock"]) == (None, "2024-01-02", "", True)


def test_typed_null(spark):
    df = spark.range(1).select(fn.typed_null().alias("a"), fn.typed_null("int").alias("b"))
    assert df.dtypes == [("a", "string"), ("b", "int")]
