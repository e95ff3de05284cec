import os
import tempfile

from tessera.operators import classes as C
from tessera.sources import tables
from tessera.sources.text import pair_lines, read_lines, read_points

SF = "/root/testdata/sf0.001"


def test_read_lines_min_partitions(spark):
    d = tempfile.mkdtemp(prefix="tessera-lines-")
    pair_lines(tables.event_pairs(spark, SF), "id", "class").coalesce(1).write.text(os.path.join(d, "p"))
    lines = read_lines(spark, os.path.join(d, "p"), min_partitions=5)
    assert lines.rdd.getNumPartitions() >= 5
    from tessera.sources.text import parse_pairs
    got = {r["class"]: r["n"] for r in C.class_count(parse_pairs(lines), 4).collect()}
    want = {r["class"]: r["n"] for r in C.class_count_direct(tables.event_pairs(spark, SF)).collect()}
    assert got == want


def test_read_points_comma_and_space(spark):
    d = tempfile.mkdtemp(prefix="tessera-points-")
    pts = tables.part_points(spark, SF)
    from pyspark.sql import functions as F
    pts.select(F.concat_ws(",", F.col("v")[0].cast("string"), F.col("v")[1].cast("string"))) \
        .write.text(os.path.join(d, "csv"))
    pts.select(F.concat_ws(" ", F.col("v")[0].cast("string"), F.col("v")[1].cast("string"))) \
        .write.text(os.path.join(d, "ssv"))
    want = sorted(tuple(r["v"]) for r in pts.collect())
    for sub, sep in (("csv", ","), ("ssv", " ")):
        back = read_points(spark, os.path.join(d, sub), sep=sep)
        assert sorted(tuple(r["v"]) for r in back.collect()) == want
        assert back.select("id").distinct().count() == len(want)


def test_sinks_round_trip(spark):
    from tessera.sources.sinks import write_parquet, write_report_line
    d = tempfile.mkdtemp(prefix="tessera-sink-")
    counts = C.class_count_by_shard(tables.event_pairs(spark, SF), 4)
    write_parquet(counts, os.path.join(d, "cc"), partition_by=["shard"])
    back = spark.read.parquet(os.path.join(d, "cc"))
    assert sorted(map(tuple, back.select("shard", "class", "n").collect())) == \
        sorted(map(tuple, counts.select("shard", "class", "n").collect()))
    write_report_line(C.class_count_line(C.class_count(tables.event_pairs(spark, SF), 4)), os.path.join(d, "line"))
    assert spark.read.text(os.path.join(d, "line")).collect()[0][0].startswith("('click', ")


def test_point_lines_strict_and_permissive(spark):
    import pytest
    from tessera.sources.text import parse_points
    lines = lambda *x: spark.createDataFrame([(v,) for v in x], "value string")
    assert [r["v"] for r in parse_points(lines("1|2.5"), sep="|").collect()] == [[1.0, 2.5]]
    for bad, sep in (("", ","), ("1,,2", ","), ("1,x", ","), ("1  2", " ")):
        with pytest.raises(Exception, match="bad point line"):
            parse_points(lines("1,2" if sep == "," else "1 2", bad), sep=sep).collect()
        assert parse_points(lines("3,4" if sep == "," else "3 4", bad), sep=sep, permissive=True).count() == 1


def test_point_ids_do_not_depend_on_splits(spark):
    from tessera.sources.text import parse_points
    df = spark.createDataFrame([(f"{i % 50},{i % 3}",) for i in range(300)], "value string")
    ids = [sorted((r["id"], tuple(r["v"])) for r in parse_points(df.repartition(n)).collect()) for n in (1, 9)]
    assert ids[0] == ids[1] and len({i for i, _ in ids[0]}) == 300
