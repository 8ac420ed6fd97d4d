"""Scalar/text/array functions against the Python semantics they replace."""

import pytest
from pyspark.sql import functions as F

from cartwheel.functions import arrays as A
from cartwheel.functions import scalar as S
from cartwheel.functions import text as TX

# Input and expected output of the live title cleaner: lower case, trimmed, then
# only ASCII letters, digits and spaces.
TITLES = [
    ('  Hello, World!  ', 'hello world'),
    ('\tTabbed\tText\n', 'tabbedtext'),
    ('\xa0NBSP\xa0', 'nbsp'),
    ('Caf\xe9 cr\xe8me', 'caf crme'),
    ('', ''),
    ('only ... !!!', 'only  '),
    ('Em\u2003space', 'emspace'),
    ('\x1cfile sep\x1f', 'file sep'),
    ('\u0130stanbul', 'istanbul'),
    ('\u212aelvin', 'kelvin'),
    ('double  inner  spaces', 'double  inner  spaces'),
    ('MiXeD 123 CaSe', 'mixed 123 case'),
    (None, None),
]

# The archived text cleaner: lower case, only a-z and white space, no stop words,
# words joined by one space.
TEXTS = [
    ('  Hello, World!  ', 'hello world'),
    ('\tTabbed\tText\n', 'tabbed text'),
    ('\xa0NBSP\xa0', 'nbsp'),
    ('Caf\xe9 cr\xe8me', 'caf crme'),
    ('', ''),
    ('only ... !!!', ''),
    ('Em\u2003space', 'em space'),
    ('\x1cfile sep\x1f', 'file sep'),
    ('\u0130stanbul', 'istanbul'),
    ('\u212aelvin', 'kelvin'),
    ('double  inner  spaces', 'double inner spaces'),
    ('MiXeD 123 CaSe', 'mixed case'),
    ("The product is not what I wanted, but it's fine", 'product wanted fine'),
    ('a an the', ''),
    (None, None),
]


def _col(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn("t")).collect()]


def test_clean_title(spark):
    assert _col(spark, [t for t, _ in TITLES], TX.clean_title) == [want for _, want in TITLES]


def test_clean_text_stop(spark):
    assert _col(spark, [t for t, _ in TEXTS], TX.clean_text_stop) == [want for _, want in TEXTS]


def test_stem3_and_safe_text(spark):
    got = _col(spark, ["great product works", "", None, "ab  abcdef"], TX.stem3)
    assert got == ["gre pro wor", "", "", "ab abc"]


def test_lemmatize_dictionary_and_identity(spark):
    got = _col(spark, ["products were bought", "unknownword", None], TX.lemmatize)
    assert got == ["product be buy", "unknownword", ""]


def test_stop_words_fixed_list():
    assert len(TX.STOP_WORDS) == 179 and len(set(TX.STOP_WORDS)) == 179


def test_event_scores(spark):
    df = spark.createDataFrame([("purchase",), ("cart",), ("view",), ("signup",), (None,)], "e string")
    rows = df.select(S.ncf_score("e"), S.engagement_score("e")).collect()
    assert [r[0] for r in rows] == [2.0, 1.0, 0.0, 0.0, 0.0]
    assert [r[1] for r in rows] == [3, 2, 1, None, None]


def test_try_casts_and_dates(spark):
    df = spark.createDataFrame([("1.5", "2024-01-02 10:00:00"), ("abc", "bad date"), ("", None)],
                               "x string, d string")
    rows = df.select(S.to_double("x"), S.to_double_or_zero("x"), S.parse_date("d")).collect()
    assert rows[0][0] == 1.5 and rows[1][0] is None and rows[2][0] is None
    assert [r[1] for r in rows] == [1.5, 0.0, 0.0]
    assert str(rows[0][2]) == "2024-01-02" and rows[1][2] is None


def test_recency_and_binarize(spark):
    df = spark.createDataFrame([("2024-01-30 12:00:00", 1.49), ("2024-01-01 00:00:00", 1.5)], "t string, p double")
    df = df.withColumn("t", F.to_timestamp("t"))
    rows = df.select(S.recency_days("t", "2024-02-01"), S.binarize("p", 1.5)).collect()
    assert [r[0] for r in rows] == [2, 31] and [r[1] for r in rows] == [0, 1]


def test_mean_arrays_skips_null_and_empty(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0], None), ([], None, [2.0, 2.0]), (None, [], [])],
                               "a array<float>, b array<float>, c array<float>")
    rows = df.select(A.mean_arrays("a", "b", "c", dim=2).alias("m")).collect()
    assert [list(r.m) for r in rows] == [[2.0, 3.0], [2.0, 2.0], [0.0, 0.0]]


def test_mean_arrays_unequal_lengths_raise(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0])], "a array<float>, b array<float>")
    with pytest.raises(Exception):
        df.select(A.mean_arrays("a", "b", dim=2)).collect()


def test_guard_dim_and_null_to_zeros(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],), (None,), ([],)], "v array<float>")
    rows = df.select(A.guard_dim("v", 2).alias("g"), A.null_to_zeros("v", 2).alias("z")).collect()
    assert [list(r.g) for r in rows] == [[1.0, 2.0], [0.0, 0.0], [0.0, 0.0], [0.0, 0.0]]
    assert list(rows[2].z) == [0.0, 0.0] and list(rows[3].z) == []


def test_keep_scored_strict_threshold(spark):
    df = spark.createDataFrame([(["a", "b", "c"], [0.5, 0.4, 0.1])], "l array<string>, s array<double>")
    assert df.select(A.keep_scored("l", "s", 0.4)).first()[0] == ["a"]


def test_items_text_and_overlap(spark):
    df = spark.createDataFrame([([3, 1, 2], [2, 5])], "a array<int>, b array<int>")
    r = df.select(A.items_text("a"), A.overlap_size("a", "b")).first()
    assert r[0] == "[1 2 3]" and r[1] == 1


def test_presence_and_round2(spark):
    df = spark.createDataFrame([(0.0, 1.005), (1.0, 2.345678), (7.0, -0.126)], "q double, x double")
    assert [tuple(r) for r in df.select(S.presence("q"), S.round2("x")).collect()] == [(0, 1.01), (1, 2.35), (1, -0.13)]
