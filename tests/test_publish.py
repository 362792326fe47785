import pytest

from cabmetrics.session import scratch_path
from cabmetrics.sources.publish import Published, replace_partitions


def test_a_second_run_replaces_its_partitions_only(spark):
    path = scratch_path(spark, "by-part")
    rows = [(i, i % 3) for i in range(90)]
    replace_partitions(spark.createDataFrame(rows, "id long, part long").repartition(5), path, ["part"])
    files = lambda: {f for f in spark.read.parquet(path).inputFiles()}
    untouched = {f for f in files() if "/part=1/" not in f}
    replace_partitions(spark.createDataFrame([(500, 1)], "id long, part long"), path, ["part"])
    now = spark.read.parquet(path)
    assert {r["part"]: r["count"] for r in now.groupBy("part").count().collect()} == {0: 30, 1: 1, 2: 30}
    assert now.filter("part = 1").first()["id"] == 500
    assert untouched < files() and len(files() - untouched) == 1


def test_readers_keep_their_version(spark):
    place = Published(spark, scratch_path(spark, "place"))
    assert place.versions() == []
    with pytest.raises(FileNotFoundError):
        place.path()
    assert place.write_table(spark.range(10)) == 1
    reader = place.read_table()
    assert place.write_table(spark.range(3)) == 2
    assert (reader.count(), place.read_table().count(), place.read_table(1).count()) == (10, 3, 10)
    assert place.versions() == [1, 2]


def test_a_write_that_fails_publishes_nothing(spark):
    place = Published(spark, scratch_path(spark, "place"))
    place.write_table(spark.range(4))

    def broken(path):
        spark.range(2).write.parquet(path)
        raise ValueError("lost")

    with pytest.raises(ValueError, match="lost"):
        place.publish(broken)
    assert place.versions() == [1] and place.read_table().count() == 4


def test_two_writers_get_two_numbers(spark):
    root = scratch_path(spark, "place")
    one, two = Published(spark, root), Published(spark, root)
    one.write_table(spark.range(1))
    # both have written their folder; the other one publishes in between
    assert one.publish(lambda path: (spark.range(5).write.parquet(path), two.write_table(spark.range(7)))) == 3
    assert place_counts(two) == {1: 1, 2: 7, 3: 5}
    # a number that was taken but never listed (its writer was lost) is passed over
    assert one._claim(4) and not two._claim(4)
    assert two.write_table(spark.range(9)) == 5 and two.read_table().count() == 9


def place_counts(place):
    return {v: place.read_table(v).count() for v in place.versions()}
