import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltframe.sources import files
from siltframe.sources.lines import csv_cells, numbered_lines, with_header


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return path


@pytest.mark.parametrize(
    "line, cells",
    [
        ("a,b,c", ["a", "b", "c"]),
        (",a,,", [None, "a", None, None]),
        ('"x, y",1', ["x, y", "1"]),
        (' "x" , y ', ["x", "y"]),
        ('"say ""hi""",""', ['say "hi"', None]),
        ('"open,b', ['"open', "b"]),
        ('"a"b,c', ['"a"b', "c"]),
        ("", [None]),
        ('"' + "a," * 5000 + '",z', ["a," * 5000, "z"]),
    ],
)
def test_cells_of_a_line(frame, line, cells):
    (row,) = frame("line string", (line,)).select(csv_cells(F.col("line")).alias("c")).collect()
    assert row.c == cells


@pytest.fixture
def small_splits(spark):
    """Splits of 64 bytes, so that small files are read in many."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for name, value in zip(names, ("64", "0")):
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def test_lines_are_numbered_over_splits(spark, tmp_path, small_splits):
    texts = {f"d{i}/f {i}.txt": [f"{i}-{k} " + "é" * (k % 9) for k in range(40 * i)] for i in range(4)}
    for name, lines in texts.items():
        put(tmp_path, name, "\r\n".join(lines))
    put(tmp_path, "d1/other.csv", "left out")
    found = numbered_lines(spark, str(tmp_path), "*.txt")
    assert spark.read.option("recursiveFileLookup", True).text(str(tmp_path)).rdd.getNumPartitions() > 20
    want = [(name, k, line) for name, lines in texts.items() for k, line in enumerate(lines)]
    got = [("/".join(r.path.split("/")[-2:]), r.line, r.value) for r in found.collect()]
    assert sorted(got) == sorted(want)
    assert numbered_lines(spark, str(tmp_path), "*.txt", "d2/").select("path").distinct().count() == 1


def test_header_meets_rows_of_other_splits(spark, tmp_path, small_splits):
    put(tmp_path, "a.csv", "\n\nx,y\n" + "".join(f"{k},{k * k}\n" for k in range(100)) + "\n")
    put(tmp_path, "b.csv", "only,header\n")
    put(tmp_path, "c.csv", "")
    got = with_header(numbered_lines(spark, str(tmp_path), "*.csv"))
    assert rows(got.select("line", "header", "cells", "leading")) == sorted(
        [(k + 3, ["x", "y"], [str(k), str(k * k)], 100) for k in range(100)], key=repr
    )


def test_age_models_keep_quoted_commas_and_refuse_uneven_rows(spark, tmp_path):
    head = "depths,sample_ids,mean,median,uncert_5,uncert_25,uncert_75,uncert_95\n"
    put(tmp_path, "bacon/sub/core/a.csv", head + '5,"A,1",1,2,3,4,5,6\n6,B,1,2,3,4,5,\n')
    found = files.read_age_model_files(spark, str(tmp_path))
    assert rows(found, "entity_name", "subfolder", "sample_ids", "depths", "uncert_95") == [
        ("core", "sub", "A,1", 5.0, 6.0), ("core", "sub", "B", 6.0, None)
    ]
    put(tmp_path, "bacon/sub/other/b.csv", head + "5,A,1,1,2,3,4,5,6\n")
    with pytest.raises(Exception, match="another number of cells"):
        files.read_age_model_files(spark, str(tmp_path)).collect()


def test_count_sheets_of_both_layouts_with_entities(spark, tmp_path, frame, small_splits):
    put(tmp_path, "One_SPH.csv", "taxon,clean,mid,top,10,x\nPinus,pine  tree,pine,tree,3,\n,none,none,none,9,9\n")
    put(tmp_path, "Two.csv", ",Name,clean,mid,top,1.5\n,Quercus,oak,oak,tree,7\n,Alnus,,,,\n")
    put(tmp_path, "Three_list.csv", 'a,b,c,d,e,f\nTilia,lime,lime,"tree, other",4,11\nUlmus,elm,elm,tree,,\n')
    put(tmp_path, "Four.csv", "name,clean,mid,top,depth,Count\nBetula,birch,birch,tree,2,5\n")
    cores = frame("site_name string, entity_name string", ("One", "O1"), ("Three", "T1"))
    got = files.read_count_sheets(spark, str(tmp_path), entities=cores)
    assert rows(got) == sorted(
        [
            ("One", "O1", "Pinus", "pine tree", "pine", "tree", 10.0, 3.0),
            ("One", "O1", "Pinus", "pine tree", "pine", "tree", None, 0.0),
            ("Two", None, "Quercus", "oak", "oak", "tree", 1.5, 7.0),
            ("Two", None, "Alnus", None, None, None, 1.5, 0.0),
            ("Three", "T1", "Tilia", "lime", "lime", "tree, other", 4.0, 11.0),
            ("Three", "T1", "Ulmus", "elm", "elm", "tree", None, None),
            ("Four", None, "Betula", "birch", "birch", "tree", 2.0, 5.0),
        ],
        key=repr,
    )
    dropped = files.read_count_sheets(spark, str(tmp_path), null_policy="drop")
    assert rows(dropped.where("site_name = 'One'"), "taxon_name", "count") == [("Pinus", 3.0), (None, 9.0), (None, 9.0)]


def test_sheet_below_remarks(spark, tmp_path, small_splits):
    body = "".join(f'{k},{"" if k % 7 == 0 else k / 2},"L, {k}"\n' for k in range(200))
    for name in ("a.csv", "b.csv"):
        put(tmp_path, name, 'remark, with "quotes"\n\nentityId,Depth (cm),lab num\n' + body + "oops,x\n")
    sheet = files.read_sheet(
        spark, str(tmp_path), T.StructType.fromDDL("entityId bigint, `Depth (cm)` double, `lab num` string"), "depth_cm", skip=2
    )
    assert rows(sheet) == sorted([(k, k / 2, f"L, {k}") for k in range(200) if k % 7] * 2, key=repr)


def test_csv_keeps_white_space_around_values(spark, frame, tmp_path):
    df = frame("a string, b long", (" x ", 1), ("\ty", 2), (None, 3))
    files.write_csv(df, str(tmp_path / "t"))
    assert rows(files.read_csv(spark, str(tmp_path / "t"), df.schema)) == rows(df)
