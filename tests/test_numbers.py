from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from starmill.functions import numbers


def _one(spark, column, schema="x long", row=(1,)):
    return spark.createDataFrame([row], schema).select(column).first()[0]


def test_equal_share(spark):
    shares = {1: "1", 2: "0.5", 3: "0.333333333333", 6: "0.166666666667", 7: "0.142857142857"}
    for n, share in shares.items():
        assert _one(spark, numbers.equal_share(F.lit(n))) == Decimal(share)
    assert _one(spark, numbers.equal_share(F.lit(0))) is None
    assert _one(spark, numbers.equal_share(F.lit(7), "decimal(20,6)")) == Decimal("0.142857")


def test_weighted_keeps_every_digit(spark):
    got = _one(
        spark,
        numbers.weighted(F.col("n"), F.col("w")),
        "n long, w decimal(20,12)",
        (9223372036854775807, Decimal("0.333333333333")),
    )
    assert str(got).replace(".", "") == str(9223372036854775807 * 333333333333)


def test_quotient_scale_and_zero(spark):
    schema, row = "t decimal(27,14), w decimal(30,12)", (Decimal("10"), Decimal("3"))
    q = numbers.quotient(F.col("t"), F.col("w"))
    assert _one(spark, q, schema, row) == Decimal("3.3333333333333333")
    assert _one(spark, q, schema, (Decimal("10"), Decimal("0"))) is None
    assert _one(spark, q, schema, (None, None)) is None


def test_quotient_beyond_the_fine_width(spark):
    """A genre with more than 10^10 weighted snapshots still has a mean."""
    schema = "t decimal(37,14), w decimal(38,12)"
    row = (Decimal("40000000000000"), Decimal("10000000000000"))
    assert _one(spark, numbers.quotient(F.col("t"), F.col("w")), schema, row) == Decimal("4")


def test_quotient_has_the_same_places_at_every_size(spark):
    schema, q = "t decimal(37,14), w decimal(38,12)", numbers.quotient(F.col("t"), F.col("w"))
    for n in (3, 9 * 10**9, 12 * 10**9, 10**14 + 1, 7 * 10**15):
        want = (Decimal(n + 1) / Decimal(n)).quantize(Decimal("1e-16"), ROUND_HALF_UP)
        assert _one(spark, q, schema, (Decimal(n + 1), Decimal(n))) == want, n


def test_scores_and_bands_of_known_totals(spark):
    # Fixed values: (total, issues) with the published score and band.
    known = [
        (10840, 1474, "0.8640", "YELLOW"),
        (10840, 1695, "0.8436", "YELLOW"),
        (10840, 1, "0.9999", "GREEN"),
        (10840, 8, "0.9993", "GREEN"),
        (10840, 2, "0.9998", "GREEN"),
        (10840, 0, "1.0000", "GREEN"),
        (41, 0, "1.0000", "GREEN"),
        (100, 5, "0.9500", "GREEN"),
        (100000, 5005, "0.9500", "GREEN"),
        (100, 20, "0.8000", "YELLOW"),
        (100, 21, "0.7900", "RED"),
    ]
    df = spark.createDataFrame(known, "total long, issues long, want string, band string")
    s = numbers.score(F.col("issues"), F.col("total"))
    for r in df.select("*", s.alias("got"), numbers.severity(s).alias("got_band")).collect():
        assert (r.got, r.got_band) == (Decimal(r.want), r.band), r


def test_nothing_checked_is_info(spark):
    df = spark.createDataFrame([(0, 0), (None, None)], "total long, issues long")
    s = numbers.score(F.col("issues"), F.col("total"))
    assert [tuple(r) for r in df.select(s, numbers.severity(s)).collect()] == [(None, "INFO")] * 2
