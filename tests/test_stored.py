import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltframe import snapshot
from siltframe.operators import ids, match, quality, reshape
from siltframe.operators.changes import KeyViolation
from siltframe.schema import SCHEMAS
from siltframe.session import checkpoint, scratch, scratch_path
from siltframe.sources import colocated
from siltframe.sources.versions import ConcurrentChange, VersionedTable

COUNTS = SCHEMAS["pollen_count"]


def files_below(path):
    return {
        os.path.relpath(os.path.join(folder, name), path): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


@pytest.fixture
def counts(spark, tmp_path):
    df = spark.range(40).select(
        (F.col("id") % 20).alias("ID_SAMPLE"), F.lit(1).cast("long").alias("ID_TAXON"), F.floor(F.col("id") / 20).cast("int").alias("amalgamation_level"),
        F.col("id").cast("double").alias("count"),
    )
    table = VersionedTable(spark, str(tmp_path / "counts"), COUNTS, ["amalgamation_level"], {"ID_SAMPLE": 10})
    assert table.version() == 0 and table.read().isEmpty()
    assert table.create(df) == 1
    return table, df


def test_a_change_writes_only_its_slots(spark, counts, frame):
    table, df = counts
    before = files_below(table.path)
    assert len(table.slots()) == 4 and rows(table.read()) == rows(df)
    slots = frame("ID_SAMPLE long, amalgamation_level int", (3, 1), (3, 1), (4, 1))
    new = frame(COUNTS.simpleString()[7:-1].replace(":", " "), (3, 9, 1, 0.5))
    assert table.replace_slice(slots, new, ["ID_SAMPLE", "amalgamation_level"]) == 2
    after = files_below(table.path)
    assert before.items() <= after.items()  # every file is still there, as it was
    added = {name.split("/", 1)[1].rsplit("/", 1)[0] for name in after.keys() - before.keys()}
    assert added == {"amalgamation_level=1/ID_SAMPLE_range=0"}
    kept = [r for r in rows(df) if not (r[0] in (3, 4) and r[2] == 1)]
    assert rows(table.read()) == sorted([*kept, (3, 9, 1, 0.5)], key=repr)
    assert rows(table.read(1)) == rows(df)  # the version before is whole too


def test_append_reads_and_rewrites_nothing(counts):
    table, df = counts
    before = files_below(table.path)
    more = df.where("ID_SAMPLE < 3").withColumn("ID_TAXON", F.lit(2).cast("long")).unionByName(df.withColumn("ID_SAMPLE", F.col("ID_SAMPLE") + 100))
    table.append(more)
    assert before.items() <= files_below(table.path).items()
    assert rows(table.read()) == rows(df.unionByName(more))
    assert len(table.slots()["amalgamation_level=0/ID_SAMPLE_range=0"]) == 2


def test_emptied_slots_and_null_keys(counts, frame):
    table, df = counts
    table.change(df.where("ID_SAMPLE < 10"), lambda old: old.where("amalgamation_level = 0"))
    assert len(table.slots()) == 3 and table.read().count() == 30
    loose = frame(COUNTS.simpleString()[7:-1].replace(":", " "), (None, 1, 0, 1.0))
    table.append(loose)
    table.change(loose, lambda old: old.withColumn("count", F.lit(2.0)))
    assert rows(table.read().where("ID_SAMPLE IS NULL")) == [(None, 1, 0, 2.0)]


def test_changes_that_fail_leave_the_table(counts):
    table, df = counts
    with pytest.raises(KeyViolation, match="outside of the changed slots"):
        table.change(df.where("ID_SAMPLE = 1"), lambda old: old.withColumn("ID_SAMPLE", F.col("ID_SAMPLE") + 10))
    assert table.version() == 1 and rows(table.read()) == rows(df)
    assert len([f for f in os.listdir(table.path) if f.startswith("change=")]) == 1
    table.append(df.limit(1))
    assert table.version() == 2 and table.read().count() == 41


def test_one_of_two_changes_side_by_side_raises(counts, spark):
    table, df = counts

    def meanwhile(old):
        VersionedTable(spark, table.path, COUNTS, ["amalgamation_level"], {"ID_SAMPLE": 10}).append(df.where("ID_SAMPLE = 15"))
        return old.where("false")

    with pytest.raises(ConcurrentChange):
        table.change(df.where("ID_SAMPLE = 1"), meanwhile)
    assert table.version() == 2 and table.read().count() == 42


def test_upsert_and_unseen_rows(counts):
    table, df = counts
    key = ["ID_SAMPLE", "ID_TAXON", "amalgamation_level"]
    table.upsert(df.where("ID_SAMPLE = 2").withColumn("count", F.lit(-1.0)), key)
    table.append_unseen(df.withColumn("ID_SAMPLE", F.col("ID_SAMPLE") + 15), key)
    stored = {r[:3]: r[3] for r in rows(table.read())}
    assert len(stored) == table.read().count() == 70
    assert stored[2, 1, 0] == -1.0 and stored[19, 1, 1] == 39.0 and stored[34, 1, 0] == 19.0


def test_slots_are_whole_numbers(spark, tmp_path):
    with pytest.raises(ValueError):
        VersionedTable(spark, str(tmp_path), COUNTS, ["count"])


def test_colocated_counts_join_without_an_exchange(spark, archive, tmp_path):
    full = archive.with_tables(**{
        t: archive.table(t).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS[t] if f.name not in archive.table(t).columns])
        for t in SCHEMAS
    })
    path = str(tmp_path)
    colocated.write_colocated(full, path, 8)
    stored = colocated.load_colocated(spark, path, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = snapshot(stored, id_entity=[1]).facts
        plan = facts._jdf.queryExecution().executedPlan().toString()
        # The counts go from the scan to the join: nothing between the two moves rows.
        above = plan[: plan.index("siltframe_pollen_count")].splitlines()
        depth = len(above[-1]) - len(above[-1].lstrip(" :+-"))
        chain = []
        for line in reversed(above):
            indent = len(line) - len(line.lstrip(" :+-"))
            if indent <= depth:
                chain.append(line.strip(" :+-"))
                depth = indent - 1
        assert any("SortMergeJoin" in line for line in chain), plan
        assert not any("Exchange" in line for line in chain), plan
        assert rows(facts, "ID_SAMPLE", "ID_TAXON", "amalgamation_level", "count") == rows(
            snapshot(archive, id_entity=[1]).facts, "ID_SAMPLE", "ID_TAXON", "amalgamation_level", "count"
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shared_files(spark):
    from siltframe.session import _shared_dir

    root = _shared_dir(spark).removeprefix("file:")
    return {os.path.join(folder, name) for folder, _, names in os.walk(root) for name in names}


def test_scratch_is_removed_with_its_scope(spark, frame):
    df = frame("a long", (3,), (1,), (2,))
    before = shared_files(spark)
    with scratch(spark) as made:
        numbered = ids.assign_ids(df, ["a"], "n")
        numbered.write.parquet(scratch_path(spark, "kept"))
        assert len(made) == 2 and shared_files(spark) != before
        with scratch(spark):
            checkpoint(df)
        assert rows(numbered) == [(1, 1), (2, 2), (3, 3)]
    assert shared_files(spark) == before
    with pytest.raises(ZeroDivisionError), scratch(spark):
        checkpoint(df)
        raise ZeroDivisionError
    assert shared_files(spark) == before


def test_nothing_is_left_of_a_query_that_was_written(spark):
    import __spark_entry__ as contract

    before = shared_files(spark)
    for key in ("assign_ids", "match_positional", "age_model_qc", "load_tables", "read_sheet_skip", "snapshot_counts_clean"):
        with scratch(spark):
            contract.queries()[key](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
        assert shared_files(spark) == before, key


def test_equal_depths_pair_the_same_way_in_every_run(spark, frame):
    mine = frame("ID_ENTITY long, ID_SAMPLE long, depth double", *[(1, k, float(k // 4)) for k in range(24)])
    other = frame("ID_ENTITY long, depth double, thickness double, note string", *[(1, float(k // 4), k % 3 / 2, f"n{k}") for k in range(24)])
    paired = lambda n: rows(match.match_positional(mine.repartition(n), other.repartition(n + 1), "ID_ENTITY", ["depth"], ["depth"]))
    first = paired(1)
    assert len(first) == 24 and all(paired(n) == first for n in (3, 7))


def test_transpose_in_blocks_and_long(frame):
    wide = frame("site string, b long, a long", ("s3", 1, None), ("s1", 2, 5), ("s2", None, 6), (None, 9, 9))
    blocks = reshape.transpose_blocks(wide, "site", "taxon", 2)
    assert [b.columns for b in blocks] == [["taxon", "s1", "s2"], ["taxon", "s3"]]
    assert rows(blocks[0]) == [("a", 5, 6), ("b", 2, None)] and rows(blocks[1]) == [("a", None), ("b", 1)]
    assert rows(reshape.transpose(wide.where("site = 's1'"), "site", "taxon", long=True)) == [("a", "s1", 5), ("b", "s1", 2)]
    assert reshape.transpose_blocks(wide.where("false"), "site", "taxon") == []


def test_wide_by_id_has_sorted_headers_and_no_name_join(frame):
    counts = frame("s long, t long, count double", (1, 7, 1.0), (1, 5, 2.0), (2, None, 3.0), (2, 8, 4.0))
    named = reshape.id_headers(counts, frame("t long, taxon string", (5, "oak"), (7, "Ash")), "t", "taxon")
    assert list(named.items()) == [("Ash", 7), ("oak", 5), ("taxon 8", 8), ("unmapped", None)]
    wide = reshape.to_wide_by_id(counts, ["s"], "t", named)
    assert wide.columns == ["s", "Ash", "oak", "taxon 8", "unmapped"]
    assert rows(wide) == [(1, 1.0, 2.0, None, None), (2, None, None, 4.0, 3.0)]
    assert "Join" not in wide._jdf.queryExecution().executedPlan().toString()


def test_registered_pivots_have_sorted_headers(spark):
    import __spark_entry__ as contract

    for key in ("counts_to_wide", "sorted_taxa_columns"):
        wide = contract.queries()[key](spark, "/root/testdata/sf0.001")
        assert wide.columns[1:] == sorted(wide.columns[1:]) and len(wide.columns) > 2


def test_fingerprint_tells_tables_apart(frame):
    one = frame("a string, b double", ("x", 1.0), (None, 2.0))
    same, moved, swapped = one.orderBy("b"), frame("a string, b double", ("x", 1.001), (None, 2.0)), frame("a string, b double", ("x", 2.0), (None, 1.0))
    of = lambda df: {r.column_name: tuple(r)[2:] for r in quality.fingerprint(df, "t").collect()}
    assert of(one) == of(same) and of(one)["a"][:2] == (2, 1)
    assert of(moved)["b"] != of(one)["b"] and of(moved)["a"] == of(one)["a"]
    assert of(swapped)["b"] == of(one)["b"] and of(swapped)["*"] != of(one)["*"]
