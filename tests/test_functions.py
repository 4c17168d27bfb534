from pyspark.sql import functions as F

from quarry.functions.sampling import hash_split_flag
from quarry.functions.text import jvm_split, jvm_trim


def test_jvm_split_rules(spark):
    df = spark.createDataFrame([("",), ("   ",), ("a b  ",), (" a  b",), (None,)], "s string")
    got = [r[0] for r in df.select(jvm_split("s", " ")).collect()]
    assert got == [[""], [], ["a", "b"], ["", "a", "", "b"], None]


def test_jvm_trim_strips_control_chars(spark):
    df = spark.createDataFrame([("\t\n ab c\r\x01",)], "s string")
    assert df.select(jvm_trim("s")).first()[0] == "ab c"


def test_hash_split_is_stable_under_repartition(spark):
    df = spark.range(5000).withColumn("f", hash_split_flag("id", 777, 0.7))
    a = {r.id for r in df.where("f").collect()}
    b = {r.id for r in df.repartition(7).where("f").collect()}
    assert a == b and 3300 < len(a) < 3700
