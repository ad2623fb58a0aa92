from starmill.operators.assertions import assert_check, assert_fk, assert_not_null, assert_unique


def violations(df):
    (row,) = df.collect()
    return row["violations"]


def test_each_kind_counts_its_violations(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "a"), (2, None), (-3, "c")]
    df = spark.createDataFrame(rows, "k long, v string")
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    assert violations(assert_unique(df, "k")) == 2 and violations(assert_unique(df, "k", "v")) == 1
    assert violations(assert_check(df, "k > 0")) == 1
    assert violations(assert_not_null(df, "k", "v")) == 2
    assert violations(assert_fk(df, "k", parent, "id")) == 1
    none = df.where("false")
    for found in (assert_unique(none, "k"), assert_check(none, "k > 0"), assert_not_null(none, "v")):
        assert violations(found) == 0
