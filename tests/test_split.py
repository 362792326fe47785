from pyspark.sql import functions as F

from cabmetrics.operators.split import fold_column, sample_to_size, split_label, train_test_split


def _keys(spark, n=5000):
    return spark.range(n).select(F.col("id").cast("string").alias("key"))


def test_split_is_partitioning_independent(spark):
    df = _keys(spark)
    a = {r.key for r in train_test_split(df.repartition(1))[1].collect()}
    b = {r.key for r in train_test_split(df.repartition(13))[1].collect()}
    assert a == b and 800 < len(a) < 1200


def test_split_parts_are_disjoint_and_complete(spark):
    df = _keys(spark)
    tr, te = train_test_split(df)
    assert tr.count() + te.count() == 5000
    assert tr.join(te, "key").count() == 0
    assert split_label(df).filter(F.col("split") == "test").count() == te.count()


def test_folds_stable_and_balanced(spark):
    df = fold_column(_keys(spark), 3)
    sizes = sorted(r["count"] for r in df.groupBy("fold").count().collect())
    assert len(sizes) == 3 and sizes[0] > 1500
    again = {r.key: r.fold for r in fold_column(_keys(spark).repartition(7), 3).collect()}
    assert all(again[r.key] == r.fold for r in df.collect())


def test_sample_to_size(spark):
    df = _keys(spark, 20000)
    n = sample_to_size(df, 2000).count()
    assert 1700 < n < 2300
    assert sample_to_size(df, 50000).count() == 20000
    assert sample_to_size(df, None).count() == 20000


def test_null_keys_have_a_side_and_a_fold(spark):
    df = spark.createDataFrame([("a",), (None,), ("",), (None,)], "key string")
    tr, te = train_test_split(df)
    assert tr.count() + te.count() == 4
    rows = fold_column(split_label(df), 3).collect()
    assert all(r.fold is not None for r in rows)
    assert len({(r.split, r.fold) for r in rows if not r.key}) == 1
