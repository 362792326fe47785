from cabmetrics.llm.exact_dedup import append_new, close_index, compact, deduplicate, indexed, normalized, open_index
from pyspark.sql import functions as F
from cabmetrics.session import scratch_path

KIND = "doc_id long, text string, digest string, keep_id string"


def answers(spark, rows, index, buckets=4):
    df = spark.createDataFrame([(*r, None, "x") for r in rows], KIND)
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in deduplicate(spark, df, index, buckets).collect()), key=repr)


def test_index_lasts_over_batches(spark):
    path = scratch_path(spark, "index")
    first = answers(spark, [(1, "Same"), (2, "sAME"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "same")], open_index(spark, path, 4))
    assert first == [(1, 7, 3, False), (2, 7, 3, False), (3, 3, 1, True), (4, 4, 1, True), (5, 6, 2, False), (6, 6, 2, True), (7, 7, 3, True)]
    again = open_index(spark, path, 4)  # another session's view of the folder
    second = answers(spark, [(8, "SAME"), (9, "new"), (10, "New"), (11, "")], again)
    assert second == [(10, 10, 2, True), (11, 6, 1, False), (8, 7, 1, False), (9, 10, 2, False)]
    assert spark.table(again).count() == 5
    assert answers(spark, [], again) == [] and spark.table(again).count() == 5


def test_index_is_bucketed_and_sorted(spark):
    index = open_index(spark, scratch_path(spark, "index"), 4)
    answers(spark, [(i, f"text {i}") for i in range(50)], index)
    said = spark.table(index).join(spark.table(index).hint("merge"), "digest")._jdf.queryExecution().toString()
    assert "Exchange" not in said and "SortMergeJoin" in said


def test_a_digest_that_two_writers_added_stands_once(spark):
    path = scratch_path(spark, "index")
    index = open_index(spark, path, 4)
    hashed = spark.createDataFrame([(1, "same"), (5, "same"), (2, "other")], "keep_id long, text string").select(F.unhex(F.sha2(normalized("text"), 256)).alias("digest"), "keep_id")
    batch = hashed.filter("keep_id < 5")
    batch.repartition(4, "digest").write.insertInto(index)
    hashed.filter("keep_id = 5").repartition(4, "digest").write.insertInto(index)  # read the index before the first one appended
    assert spark.table(index).count() == 3 and indexed(spark, index).count() == 2
    assert answers(spark, [(7, "same"), (8, "SAME"), (9, "other")], index) == [(7, 5, 2, False), (8, 5, 2, False), (9, 2, 1, False)]
    files = len(spark.table(index).inputFiles())
    one = compact(spark, index, scratch_path(spark, "compacted"), 4)
    assert spark.table(one).count() == 2 and len(spark.table(one).inputFiles()) <= 4 < files + 3
    assert answers(spark, [(10, "same")], one) == [(10, 5, 1, False)]
    close_index(spark, index)
    close_index(spark, one)
    assert not spark.catalog.tableExists(index) and not spark.catalog.tableExists(one)
    assert spark.table(open_index(spark, path, 4)).count() == 3  # the folder stays


def test_a_batch_reads_the_index_without_a_shuffle(spark):
    index = open_index(spark, scratch_path(spark, "index"), 4)
    answers(spark, [(i, f"text {i}") for i in range(50)], index)
    groups = spark.createDataFrame([(b"x", 1)], "digest binary, keep_id long")
    known = spark.table(index).select("digest")
    plan = groups.join(known.hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan  # the batch's side only
    append_new(spark, index, groups, 4)
    assert spark.table(index).count() == 51


def test_repeated_rows_and_null_ids(spark):
    got = answers(spark, [(1, "a"), (1, "a"), (None, "a"), (None, "b")], open_index(spark, scratch_path(spark, "index"), 4))
    assert got == sorted([(1, 1, 3, True), (1, 1, 3, True), (None, 1, 3, False), (None, None, 1, True)], key=repr)
