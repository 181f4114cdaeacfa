import pytest
from pyspark.sql import functions as F

from vaultloom.functions import people, text
from vaultloom.functions.keys import float_input, hash_key, hex_key

CITIES = ["santa bárbara d'oeste", "embu-guacu", "rio 2a x", "MOJI MIRIM", "águas claras",
          "são joão  del-rei", "o'neil_mc2d", "", "中a b", "x́y", None]


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")


def column(df, expression):
    return [r.x for r in df.orderBy("i").selectExpr(f"{expression} AS x").collect()]


def test_title_case_is_pythons(spark):
    got = column(texts(spark, CITIES), text.title_case("c"))
    assert got == [None if c is None else c.title() for c in CITIES]


def test_capitalize_is_pythons(spark):
    got = column(texts(spark, CITIES), text.capitalize("c"))
    assert got == [None if c is None else c.capitalize() for c in CITIES]


def test_underscores_and_missing_tokens(spark):
    df = texts(spark, ["credit_card", "NA", "n/a", "", "null", "NaN", "nano", None])
    assert column(df, text.underscores_to_spaces("c"))[0] == "credit card"
    assert column(df, text.blank_missing("c")) == [
        "credit_card", None, None, None, None, None, "nano", None]


def test_hash_key_tells_pairs_apart(spark):
    pairs = [(None, "a"), ("a", None), ("a|b", "c"), ("a", "b|c"), (None, None), ("", None), ("N", None)]
    df = spark.createDataFrame(pairs, "a string, b string")
    keys = [r.k for r in df.selectExpr(f"{hash_key('a', 'b')} AS k").collect()]
    assert len(set(keys)) == len(pairs)
    assert all(0 <= k < 2 ** 60 for k in keys)
    assert all(len(r.k) == 32 for r in df.selectExpr(f"{hex_key('a', 'b')} AS k").collect())


def test_both_zeros_give_one_key(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,)], "d double")
    assert df.selectExpr(f"{hash_key(float_input('d'))} AS k").distinct().count() == 1


def test_generated_attributes_depend_on_the_key_only(spark):
    df = spark.range(500).selectExpr("concat('C', id) AS k")
    made = [people.person_name("k"), people.email("k"), people.phone_number("k"),
            people.birth_date("k"), people.product_name("k")]
    once = df.selectExpr("k", *[f"{e} AS a{i}" for i, e in enumerate(made)])
    again = df.repartition(7).selectExpr("k", *[f"{e} AS a{i}" for i, e in enumerate(made)])
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()
    assert once.filter(F.octet_length("a1") > 50).isEmpty()
    assert once.select("a0").distinct().count() > 100


@pytest.mark.parametrize("key", ["NULL", "''"])
def test_generated_attributes_accept_missing_keys(spark, key):
    row = spark.range(1).selectExpr(f"{people.email(f'cast({key} AS string)')} AS e").first()
    assert "@example." in row.e


def test_floating_key_text_is_exact(spark):
    from fractions import Fraction

    numbers = [0.1, -0.1, 1 / 3, -22.5, 179.99999999999997, 180.0, 0.30000000000000004, 0.3, 2.0 ** -10, 12345678.9]
    df = spark.createDataFrame([(x,) for x in numbers], "d double")
    for x, r in zip(numbers, df.selectExpr(f"{float_input('d')} AS t").collect(), strict=True):
        sign, (whole, rest) = -1 if r.t[0] == "-" else 1, r.t.lstrip("-").split("+")
        assert sign * (int(whole) + Fraction(int(rest), 1 << 62)) == Fraction(x)
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (1e300,), (None,)], "d double")
    assert [r.t for r in odd.selectExpr(f"{float_input('d')} AS t").collect()] == ["NaN", "Infinity", "1.0E300", None]
