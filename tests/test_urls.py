"""One spelling of URLs and their parameters."""

import pytest
from pyspark.sql import functions as F

from geolayer.errors import InputTypeError
from geolayer.operators import requests as req


def normal(spark, urls):
    rows = spark.createDataFrame(list(enumerate(urls)), "request_id int, url string")
    return [r.norm_url for r in req.normalize_urls(rows).orderBy("request_id").collect()]


def test_spellings_of_a_query(spark):
    same = ["http://h/p?x=%41&y=a%20b", "http://h/p?y=a+b&x=A", "HTTP://H:80/p?&x=A&&y=%61%20b#top"]
    assert normal(spark, same) == ["http://h/p?x=A&y=a%20b"] * 3
    apart = ["http://h/p?x=a%26y=b", "http://h/p?x=a&y=b", "http://h/p?x", "http://h/p?x=", "http://h/p?x=a%2Bb",
             "http://h/p?x=a+b", "http://h/p?x=1&x=2", "http://h/p?x=2", "http://h/p?x=%FF", "http://h/p?x=%FE",
             "http://h/p?x=%EF%BF%BD", "http://h/p?x=%25", "http://h/p?x=%2525", "http://h/p?x=a=b", "http://h/%41"]
    got = normal(spark, apart)
    assert len(set(got)) == len(apart)
    assert normal(spark, got) == got
    odd = ["http://h/p?x=50%", "http://h/p?x=%zz", "http://h/p?x=%ff", None, "no url?x=%41", ""]
    assert normal(spark, odd) == [
        "http://h/p?x=50%25", "http://h/p?x=%25zz", "http://h/p?x=%FF", None, "no url?x=%41", ""]


@pytest.mark.parametrize("params", [
    lambda: F.create_map(F.lit("b"), F.lit("1 +%41"), F.lit("a"), F.lit("é&=")),
    lambda: F.array(F.struct(F.lit("b").alias("n"), F.lit("1 +%41").alias("v")),
            F.struct(F.lit("a").alias("n"), F.lit("é&=").alias("v")),
            F.struct(F.lit("c").alias("n"), F.lit(None).cast("string").alias("v"))),
    lambda: F.lit("b=1+%2B%2541&a=%C3%A9%26%3D"),
    lambda: F.encode(F.lit("?a=é%26=&b=1%20%2b%2541"), "UTF-8"),
])
def test_parameters_in_every_form(spark, params):
    row = spark.createDataFrame([("http://h/p?z=0",)], "url string").withColumn("params", params())
    assert req.with_request_key(row).first().norm_url == "http://h/p?a=%C3%A9%26%3D&b=1%20%2B%2541&z=0"


def test_repeated_and_null_parameters(spark):
    rows = spark.createDataFrame(
        [(0, "http://h", [("a", "2"), ("a", "1"), ("a", "2")]), (1, "http://h", []), (2, "http://h", None)],
        "request_id int, url string, params array<struct<name:string,value:string>>")
    got = [r.norm_url for r in req.normalize_urls(rows, "url", "params").orderBy("request_id").collect()]
    assert got == ["http://h/?a=1&a=2&a=2", "http://h/", "http://h/"]
    with pytest.raises(InputTypeError):
        req.normalize_urls(rows, "url", "request_id")
