import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from yearloom.functions import (
    clean_key,
    date_from_parts,
    safe_double,
    two_digits,
    year_from_filename,
)


def apply(spark, values, kind, expression):
    """The expression on each value, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "raw, key",
    [
        ("Sarrià - Sant Gervasi", "sarrià-sant gervasi"),
        (" Sants-Montjuïc ", "sants-montjuïc"),
        ("Horta Guinardó", "horta guinardó"),
        ("HORTA -\tGUINARDÓ", "horta-guinardó"),
        ("L'Eixample", "l'eixample"),
        ("", ""),
        (" - ", "-"),
        (None, None),
    ],
)
def test_clean_key(spark, raw, key):
    assert apply(spark, [raw], "string", clean_key) == [key]


def test_clean_key_is_the_plain_rule_and_idempotent(spark):
    rng = random.Random(7)
    letters = " \t\n\x0b\f\r-aÀçB'1"
    raws = ["".join(rng.choices(letters, k=rng.randint(0, 12))) for _ in range(5000)]
    keys = apply(spark, raws, "string", clean_key)
    plain = [re.sub("[ \t\n\x0b\f\r]*-[ \t\n\x0b\f\r]*", "-", r).strip(" ").lower() for r in raws]
    assert keys == plain
    assert apply(spark, keys, "string", clean_key) == keys


@pytest.mark.parametrize(
    "parts, expected",
    [
        ((2014, 2, 3), date(2014, 2, 3)),
        ((2014, 12, 31), date(2014, 12, 31)),
        ((2014, 2, 30), None),
        ((2014, 13, 1), None),
        ((None, 2, 3), None),
        ((2014, None, 3), None),
        ((2014, 2, None), None),
        ((2014, 2, 123), date(2014, 2, 12)),  # only two digits count
    ],
)
def test_date_from_parts(spark, parts, expected):
    df = spark.createDataFrame([parts], "y int, m int, d int")
    assert df.select(date_from_parts("y", "m", "d")).first()[0] == expected


def test_two_digits(spark):
    assert apply(spark, [3, 12, 123, None], "int", two_digits) == ["03", "12", "12", None]


def test_year_from_filename(spark):
    pattern = r"(\d{4})_\d{2}_\d{2}_items\.json"
    paths = [
        "file:/a/2020_01_02_items.json",
        "2021_11_30_items.json",
        "listing.json",
        "2020_1_2_items.json",
        "2020_01_02_itemsXjson",
        None,
    ]
    years = apply(spark, paths, "string", lambda c: year_from_filename(c, pattern))
    assert years == [2020, 2021, None, None, None, None]


def test_safe_double(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    values = apply(spark, ["1.5", "-", "", "1e3", " 7 ", None], "string", safe_double)
    assert values == [1.5, None, None, 1000.0, 7.0, None]
