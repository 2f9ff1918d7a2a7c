import datetime as dt
import decimal
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from casetrace.functions import exact_percent, is_deceased, parse_date, parse_score


def test_parse_date_cases(spark):
    df = spark.createDataFrame(
        [("25/03/2020 14:30",), ("05/04/2020",), ("31/02/2020",), ("5/4/2020",),
         ("2020-03-25",), (None,), ("15/4/2020",), ("29/02/2020 00:00:00",)], "t string")
    got = [r.v for r in df.select(parse_date("t").alias("v")).collect()]
    assert got == [dt.date(2020, 3, 25), dt.date(2020, 4, 5), None, None, None, None, None,
                   dt.date(2020, 2, 29)]


def test_parse_score_rounds_half_away_and_checks_range(spark):
    df = spark.createDataFrame(
        [("5",), ("5.5",), ("-5.5",), ("123",), ("99.4",), ("99.5",), ("abc",), (None,),
         ("-99",)], "t string")
    got = [r.v for r in df.select(parse_score("t").alias("v")).collect()]
    assert got == [5, 6, -6, None, 99, None, None, None, -99]


def test_exact_percent_matches_decimal_half_up(spark):
    pairs = [(n, dd) for dd in range(1, 201) for n in range(0, dd + 1)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = {(r.n, r.d): r.p for r in df.select("n", "d", exact_percent("n", "d").alias("p"))
           .collect()}
    for n, dd in pairs:
        want = float((Decimal(n) * 100 / Decimal(dd)).quantize(Decimal("0.01"), ROUND_HALF_UP))
        assert got[(n, dd)] == want, (n, dd)
    assert got[(23, 160)] == 14.38


def test_exact_percent_zero_base_is_null(spark):
    df = spark.createDataFrame([(1, 0)], "n long, d long")
    assert df.select(exact_percent("n", "d").alias("p")).first().p is None


def test_is_deceased_by_status_or_date(spark):
    df = spark.createDataFrame(
        [("dead", None), ("ill", dt.date(2020, 1, 1)), ("ill", None)],
        "status string, died_on date")
    got = [r.x for r in df.select(is_deceased("dead").alias("x")).collect()]
    assert got == [True, True, False]


@pytest.mark.parametrize("seed", range(3))
def test_scores_against_exact_decimals(spark, seed):
    """Digits of any length and exponents, rounded once."""
    rng = random.Random(seed)
    texts = ["5.49999999995", "5.4" + "9" * 60, "-0.5", "0.5", "99.4999", "99.5", "-99.5", "1e1", "-1.5E+0", ".5",
             "5.", "1e-1", "49e-1", "4.5e-1", "995e-1", "994e-1", "0e9999", "000012.50", "1e99999", "+7", "1e2",
             "0.00995e4", "", "-", ".", "e5", "1e", "NaN", "Infinity", "1,5", "0x10", "1 2", "--1", "5d", "9" * 80]
    for _ in range(300):
        whole, part = "".join(rng.choices("0159", k=rng.randrange(4))), "".join(rng.choices("0459", k=rng.randrange(30)))
        exponent = rng.choice(["", "", f"e{rng.randrange(-6, 6)}"])
        texts.append(rng.choice(["", "-", "+"]) + (whole or "0") + "." + part + exponent)

    def want(text):
        try:
            value = Decimal(text) if text[:1] not in "NIs" else None
        except ArithmeticError:
            return None
        if value is None or not value.is_finite():
            return None
        if abs(value) >= 1000:
            return None
        rounded = int(value.quantize(Decimal(1), ROUND_HALF_UP)) if value else 0
        return rounded if -99 <= rounded <= 99 else None

    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_score("t").alias("n")).collect()
    with decimal.localcontext(prec=200):
        assert {r.t: r.n for r in rows} == {t: want(t) for t in texts}
