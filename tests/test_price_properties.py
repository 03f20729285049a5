"""Randomised check of the price formulas against Python decimals.

The expected values follow SURVEY §2.11 written directly with the decimal
module (half-up rounding, ceiling to a nickel, ROUND length 2 * pack).
All generated cases go through Spark in one DataFrame.
"""

from decimal import ROUND_CEILING, ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillprice.functions import pricing

Q2 = Decimal("0.01")


def _round(x: Decimal, n: int) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-n), rounding=ROUND_HALF_UP) if n < 6 else x


def expected(pct: Decimal, gross: Decimal, pack: int):
    u = pct * gross
    r = _round(u, 2)
    nickel = lambda v: Decimal("0.05") * (v * 20).to_integral_value(rounding=ROUND_CEILING)
    ceiling = nickel(u) if r > Decimal("9.99") else r
    r8 = nickel(u * pack) if r > Decimal("9.99") else _round(u, 2 * pack)
    r9 = _round(u * pack, 2)
    net = _round(r.quantize(Q2, rounding=ROUND_HALF_UP) * pct.quantize(Q2, rounding=ROUND_HALF_UP), 2)
    return float(r), float(ceiling), float(r8), float(r9), float(net)


# percentages up to 1.0000: the net price casts CalcPrice to numeric(7,2), like the reference
cases = st.lists(st.tuples(st.integers(0, 10000), st.integers(0, 9999999), st.integers(1, 4)),
                 min_size=20, max_size=60)


@settings(max_examples=15, deadline=None)
@given(cases)
def test_price_formulas_match_decimal_arithmetic(spark, rows):
    data = [(Decimal(p).scaleb(-4), Decimal(g).scaleb(-2), k) for p, g, k in rows]
    df = spark.createDataFrame(data, "pct decimal(5,4), gross decimal(7,2), pack int")
    u = pricing.pct_of(F.col("pct"), F.col("gross"))
    pack = pricing.to_numeric(F.col("pack"), 5, 2)
    r8 = F.when(pricing.round_money(u) > pricing.dec(pricing.CEILING_THRESHOLD),
                pricing.ceil_to_nickel(u, pack)).otherwise(
                    pricing.round_dynamic_scale(u, F.lit(2) * pack))
    net = pricing.round_money(pricing.to_numeric(pricing.round_money(u), 7, 2)
                              * pricing.to_numeric(F.col("pct"), 7, 2))
    out = df.select(*[c.cast("double") for c in (
        pricing.round_money(u), pricing.ceiling_price(u), r8,
        pricing.round_money(u * pack), net)]).collect()
    assert [tuple(r) for r in out] == [expected(*d) for d in data]
