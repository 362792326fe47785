from cabmetrics.plans import common as K
from cabmetrics.streaming import run_feature_stream


def test_stream_equals_batch(spark, sf_small):
    s = run_feature_stream(spark, sf_small)
    b = K.features(spark, sf_small)
    assert s.count() == b.count() > 600
    assert s.select(*b.columns).exceptAll(b).count() == 0


def test_score_stream_matches_batch(spark, sf_small):
    from pyspark.sql import functions as F

    from cabmetrics.operators import models as M
    from cabmetrics.schema import ModelProfile
    from cabmetrics.session import scratch_path
    from cabmetrics.streaming import feature_stream, score_stream

    train, _ = K.split(spark, sf_small)
    model = M.fit("rf", train, profile=ModelProfile(rf_num_trees=5, rf_max_depth=3))
    out = scratch_path(spark, "scores")
    q = (
        score_stream(feature_stream(spark, sf_small), model)
        .select("key", "prediction")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", out + "-ckpt")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    streamed = spark.read.parquet(out)
    batch = model.transform(K.features(spark, sf_small)).select("key", "prediction")
    j = streamed.join(batch.withColumnRenamed("prediction", "b"), "key")
    assert streamed.count() == j.count() == batch.count()
    assert j.filter(F.abs(F.col("prediction") - F.col("b")) > 1e-12).count() == 0
