import pytest
from pyspark.errors import PySparkException

from tessera.operators import classes as C
from tessera.sources.text import parse_pairs

# fixture F1: the 20 labeled pairs of the sample input
F1 = ("0 Fantasy;1 Western;2 Fantasy;3 Western;4 Action;5 Western;6 Western;7 Western;"
      "8 Western;9 Western;10 Action;11 Western;12 Fantasy;13 Western;14 Western;15 Western;"
      "16 Western;17 Thriller;18 Animation;19 Fantasy").split(";")


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(x,) for x in F1], "value string")


def as_dict(df, k="class", v="n"):
    return {r[k]: r[v] for r in df.collect()}


def test_class_count(lines):
    pairs = parse_pairs(lines)
    want = {"Action": 2, "Animation": 1, "Fantasy": 4, "Thriller": 1, "Western": 12}
    assert as_dict(C.class_count(pairs, 4)) == want
    assert as_dict(C.class_count_direct(pairs)) == want
    assert C.pair_count(pairs).collect()[0]["n_pairs"] == 20


def test_by_shard_and_max(lines):
    pairs = parse_pairs(lines)
    got = {(r["shard"], r["class"]): r["n"] for r in C.class_count_by_shard(pairs, 4).collect()}
    assert got == {(0, "Action"): 1, (0, "Fantasy"): 2, (0, "Western"): 2, (1, "Thriller"): 1,
                   (1, "Western"): 4, (2, "Action"): 1, (2, "Animation"): 1, (2, "Fantasy"): 1,
                   (2, "Western"): 2, (3, "Fantasy"): 1, (3, "Western"): 4}
    assert C.max_partition_size(pairs, 4).collect()[0][0] == 5
    assert sum(got.values()) == 20


def test_most_frequent_and_line(lines):
    pairs = parse_pairs(lines)
    counts = C.class_count(pairs, 4)
    assert C.most_frequent_class(counts).collect()[0]["class"] == "Western"
    line = C.class_count_line(counts).collect()[0]["line"]
    assert line == ("('Action', 2) ('Animation', 1) ('Fantasy', 4) ('Thriller', 1) ('Western', 12)")


def test_with_max_kind_column(spark):
    lines = spark.createDataFrame([("1 maxPartitionSize",), ("2 maxPartitionSize",), ("-3 A",)],
                                  "value string")
    rows = C.class_count_with_max(parse_pairs(lines), 2).collect()
    got = {(r["kind"], r["class"]): r["n"] for r in rows}
    # -3 mod 2 = 1 (non-negative, as in Python); shard 1 holds ids 1 and -3
    assert got == {("class", "maxPartitionSize"): 2, ("class", "A"): 1, ("max_partition_size", None): 2}


def test_tie_goes_alphabetical(spark):
    lines = spark.createDataFrame([("1 b",), ("2 a",), ("3 b",), ("4 a",)], "value string")
    assert C.most_frequent_class(C.class_count(parse_pairs(lines), 3)).collect()[0]["class"] == "a"


def test_parse_modes(spark):
    lines = spark.createDataFrame([("20 Science Fiction",)], "value string")
    assert parse_pairs(lines, "rest").collect()[0]["class"] == "Science Fiction"
    assert parse_pairs(lines, "token").collect()[0]["class"] == "Science"


def test_bad_lines_raise_or_drop(spark):
    bad = spark.createDataFrame([("x Western",), ("7",)], "value string")
    with pytest.raises(PySparkException):
        parse_pairs(bad.limit(1)).collect()
    with pytest.raises(PySparkException):
        parse_pairs(bad.where("value = '7'")).collect()
    assert parse_pairs(bad, permissive=True).count() == 0


def test_empty_input(spark):
    empty = spark.createDataFrame([], "id long, class string")
    assert C.max_partition_size(empty, 3).collect()[0][0] == 0
    assert C.class_count(empty, 3).count() == 0
    assert C.class_count_line(C.class_count(empty, 3)).collect()[0]["line"] == ""


def test_physical_partition_statistic(spark):
    # K=None measures the physical partitions (layout-dependent by design)
    pairs = spark.createDataFrame([(i, "a") for i in range(10)], "id long, class string").coalesce(1)
    assert C.max_partition_size(pairs, None).collect()[0][0] == 10
    sizes = [r["n"] for r in C.shard_sizes(pairs.repartition(2), None).collect()]
    assert sum(sizes) == 10 and len(sizes) == 2


def test_checkpoint_dir_is_read_from_session(spark):
    from tessera.session import ensure_checkpoint_dir
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
