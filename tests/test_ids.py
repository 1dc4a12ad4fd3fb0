from conftest import rows
from pyspark.sql import functions as F

from siltframe.operators import ids


def test_positions_equal_a_sort_even_in_one_hot_group(spark):
    """Most rows share one group and several partitions; the numbering is still without a gap."""
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id") % 7).alias("g"), ((F.col("id") * 7919) % 5003).alias("v")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(ids.with_position(df, ["v"], "p", ["g"]), "g", "v", "p")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want, groups = [], {}
    for r in df.collect():
        groups.setdefault(r.g, []).append(r.v)
    for g, vs in groups.items():
        want += [(g, v, i) for i, v in enumerate(sorted(vs), 1)]
    assert got == sorted(want, key=repr)


def test_ids_follow_the_order_with_nulls_last(frame):
    df = frame("n string", ("b",), (None,), ("a",))
    assert rows(ids.assign_ids(df, ["n"], "i", 10)) == [("a", 11), ("b", 12), (None, 13)]


def test_group_ids_join_null_to_null(frame):
    df = frame("n string, x int", ("b", 1), (None, 2), ("b", 3))
    assert rows(ids.assign_group_ids(df, ["n"], "i"), "n", "x", "i") == [("b", 1, 1), ("b", 3, 1), (None, 2, 2)]


def test_next_id_of_an_empty_table_and_gaps(frame):
    df = frame("i long", (2,), (5,))
    assert ids.current_max_id(df, "i") == 5
    assert ids.current_max_id(df.where("i > 9"), "i") == 1
    assert rows(ids.id_gaps(df, "i")) == [(1,), (3,), (4,)]
