import glob

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltframe import NoRecords, create_archive, db_summary, db_summary_totals, load_archive, snapshot, write_archive, write_csvs
from siltframe.plans import summary
from siltframe.schema import MODEL_NAMES, SCHEMAS, TABLES
from siltframe.sources import files


def entities(snap):
    return rows(snap.entity, "ID_ENTITY")


def test_every_way_to_select(archive, frame):
    assert entities(snapshot(archive)) == [(1,), (2,), (3,), (4,)]
    assert entities(snapshot(archive, id_entity=1)) == [(1,)]
    assert entities(snapshot(archive, id_site=[1, 3])) == [(1,), (2,), (4,)]
    assert entities(snapshot(archive, entity_name="A1")) == [(1,), (4,)]
    assert entities(snapshot(archive, site_name=["Beta"])) == [(3,)]
    assert entities(snapshot(archive, id_entity=[2], site_name="Beta")) == [(2,)]
    assert entities(snapshot(archive, frame("site_name string, ID_SITE long", ("Beta", 3)))) == [(4,)]
    assert entities(snapshot(archive, id_entity=range(2, 2000))) == [(2,), (3,), (4,)]
    with pytest.raises(ValueError):
        snapshot(archive, frame("other string", ("Beta",)))


def test_no_records(archive):
    empty = snapshot(archive, site_name="Nowhere")
    assert empty.entity.count() == 0 and empty.sample.count() == 0
    assert empty.wide("clean").columns == ["ID_SAMPLE"]
    with pytest.raises(NoRecords):
        snapshot(archive, site_name="Nowhere", require_records=True)


def test_linked_rows_and_wide_counts(archive):
    snap = snapshot(archive, id_entity=1)
    assert rows(snap.date_info, "ID_DATE_INFO") == [(1,), (2,)]
    assert rows(snap.age_model, "ID_SAMPLE", "model_name") == [(10, "BACON_INTCAL20"), (10, "linear"), (11, "BACON_INTCAL20")]
    assert set(snap.pollen_count) == {"clean", "intermediate", "amalgamated"}
    clean = snap.wide("clean")
    assert clean.columns == ["ID_SAMPLE", "oak", "pine"]
    assert rows(clean) == [(10, 0.0, 3.0), (11, 4.0, None)]
    assert rows(snap.long("amalgamated")) == [(10, "tree", 3.0), (11, "tree", 4.0)]


def test_whole_archive_leaves_out_counts_of_unknown_samples(archive, frame):
    orphan = frame("ID_SAMPLE long, ID_TAXON long, amalgamation_level int, count double", (99, 1, 0, 1.0))
    snap = snapshot(archive.with_tables(pollen_count=archive.pollen_count.unionByName(orphan)))
    assert rows(snap.wide("clean"), "ID_SAMPLE") == [(10,), (11,), (20,)]
    assert rows(snap.long("clean"), "ID_SAMPLE") == [(10,), (10,), (11,), (20,)]


def test_stats_count_model_rows_and_samples_with_counts(archive):
    stats = snapshot(archive).stats()
    assert rows(stats, "ID_ENTITY", "dates", "samples", "age_model", "pollen_counts.*") == [
        (1, 2, 2, 3, 2, 2, 2),
        (2, 0, 1, 1, 1, 0, 0),
        (3, 1, 1, 0, 0, 0, 0),
        (4, 0, 0, 0, 0, 0, 0),
    ]


def test_summary_keeps_the_flags_of_an_undated_entity(archive):
    got = db_summary(archive)
    assert rows(got, "ID_ENTITY", "n_am", "n_counts", "has_DATES", "has_SAMPLES", "has_AM", "has_COUNTS", "COUNTS_0", "levels_agree") == [
        (1, 2, 2, True, True, True, True, True, True),
        (2, 1, None, False, True, True, False, True, False),
        (3, None, None, True, True, False, False, False, True),
        (4, None, None, False, False, False, False, False, True),
    ]
    assert rows(db_summary_totals(got)) == [(4, 2, 2, 1)]
    assert rows(summary.complete_entities(archive)) == [(1,)]
    assert rows(summary.uncounted_entities(archive), "ID_ENTITY") == [(3,)]
    with pytest.raises(summary.LevelMismatch):
        db_summary(archive, strict=True)


def test_bundle_of_seven_tables(archive, tmp_path):
    snap = snapshot(archive, id_entity=[1, 2])
    prefix = str(tmp_path / "out")
    assert write_csvs(snap, prefix, single_file=True) is snap
    parts = sorted(p.rsplit("/", 1)[1] for p in glob.glob(f"{prefix}_*"))
    assert parts == sorted(p.rsplit("/", 1)[1] for p in files.snapshot_files(prefix).values())
    (clean,) = glob.glob(f"{prefix}_pollen_counts_clean.csv/part-*.csv")
    assert sorted(open(clean).read().split()) == sorted(["ID_SAMPLE,oak,pine", "10,0.0,3.0", "11,4.0,NA", "20,NA,7.0"])
    with pytest.raises(FileNotFoundError):
        write_csvs(snap, str(tmp_path / "missing" / "out"))
    with pytest.raises(TypeError):
        write_csvs(archive, prefix)


def test_archive_on_disk(spark, archive, tmp_path):
    path = str(tmp_path / "store")
    empty = create_archive(spark, path)
    assert rows(empty.model_name) == sorted(MODEL_NAMES, key=repr)
    assert empty.pollen_count.count() == 0
    assert {t: empty.table(t).schema.names for t in TABLES}["sample"] == SCHEMAS["sample"].names
    full = {}
    for name in TABLES:
        table = archive.table(name)
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS[name] if f.name not in table.columns]
        full[name] = table.select("*", *missing).select(*SCHEMAS[name].names)
    write_archive(archive.with_tables(**full), str(tmp_path / "full"))
    stored = load_archive(spark, str(tmp_path / "full"))
    assert rows(stored.pollen_count.select(*SCHEMAS["pollen_count"].names)) == rows(full["pollen_count"])
    plan = stored.pollen_count.where("amalgamation_level = 2 AND ID_SAMPLE BETWEEN 1 AND 5")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(amalgamation_level" in plan and "GreaterThanOrEqual(ID_SAMPLE,1)" in plan


def test_age_model_files_take_their_names_from_the_folders(spark, tmp_path):
    head = "sample_ids,depths,mean,median,uncert_5,uncert_25,uncert_75,uncert_95\n"
    for folder, name in [("ready/Lake é + 1", "bacon_1.csv"), ("ready/B", "bacon.csv"), ("old/B", "clam.csv")]:
        target = tmp_path / folder
        target.mkdir(parents=True, exist_ok=True)
        (target / name).write_text(head + "a,1.5,10,11,1,2,3,4\n")
    found = files.read_age_model_files(spark, str(tmp_path))
    assert rows(found, "subfolder", "entity_name", "depths", "mean") == [("ready", "B", 1.5, 10.0), ("ready", "Lake é + 1", 1.5, 10.0)]


def test_count_file_names():
    assert files.sheet_from_path("/in/Blue Lake_LIST_SPH.csv") == ("Blue Lake", True)
    assert files.sheet_from_path("Blue Lake.csv") == ("Blue Lake", False)


def test_count_sheets_in_both_layouts(frame):
    columns = "number string, name string, clean string, intermediate string, amalgamated string"
    matrix = frame(f"{columns}, `10` string, `20.5` string", (None, "pine", " Pinus  s", "conifer", "tree", "3", None))
    listed = frame(f"{columns.replace('number string, ', '')}, depth string, Count string", ("oak", "oak", "oak", "tree", "7", None))
    got = files.harmonise_count_sheets([("S", "E", matrix, False), ("S", "F", listed, False)])
    assert rows(got, "entity_name", "taxon_name", "clean", "depth", "count") == [
        ("E", "pine", "Pinus s", 10.0, 3.0),
        ("E", "pine", "Pinus s", 20.5, 0.0),
        ("F", "oak", "oak", 7.0, None),
    ]


def test_age_model_columns_are_found_by_header(spark, tmp_path):
    for name, head, row in [
        ("a", "depths,sample_ids,median,mean,uncert_95,uncert_25,uncert_75,uncert_5", "7.0,s,2,1,95,25,75,5"),
        ("b", '"sample_ids","depths","mean","median","uncert_5","uncert_25","uncert_75","uncert_95"', '"s",8.0,1,2,5,25,75,95'),
    ]:
        folder = tmp_path / "runs" / name
        folder.mkdir(parents=True)
        (folder / "bacon.csv").write_text(f"{head}\n{row}\n")
    found = files.read_age_model_files(spark, str(tmp_path / "runs"))
    assert rows(found, *files.AGE_MODEL_FILE.names) == [("s", d, 1.0, 2.0, 5.0, 25.0, 75.0, 95.0) for d in (7.0, 8.0)]
    (tmp_path / "runs" / "b" / "bacon2.csv").write_text("sample_ids,depths\ns,1\n")
    with pytest.raises(Exception, match="no column mean"):
        files.read_age_model_files(spark, str(tmp_path / "runs")).collect()


def test_csv_comes_back_as_it_was_written(spark, frame, tmp_path):
    df = frame("k int, v string", (1, 'A;\nB'), (2, 'say "x", y'), (3, None), (4, "back\\slash"))
    files.write_csv(df, str(tmp_path / "t"), "NA")
    assert rows(files.read_csv(spark, str(tmp_path / "t"), df.schema, "NA")) == rows(df)


def test_counts_without_a_name_keep_their_column(archive, frame):
    more = frame("ID_SAMPLE long, ID_TAXON long, amalgamation_level int, count double", (10, 99, 0, 5.0), (11, None, 0, 6.0), (20, 7, 0, 8.0))
    named = archive.taxon_name.unionByName(frame("ID_TAXON long, taxon_name string", (7, None)))
    wide = snapshot(archive.with_tables(pollen_count=archive.pollen_count.unionByName(more), taxon_name=named)).wide("clean")
    assert wide.columns == ["ID_SAMPLE", "oak", "pine", "taxon 7", "taxon 99", "unmapped"]
    assert rows(wide, "ID_SAMPLE", "taxon 99", "unmapped", "taxon 7") == [(10, 5.0, None, None), (11, None, 6.0, None), (20, None, None, 8.0)]


def test_lists_of_any_length_select_by_a_join(archive):
    plans = [snapshot(archive, id_entity=list(range(n))).entity._jdf.queryExecution().optimizedPlan().toString() for n in (10, 1000)]
    assert all("Join LeftSemi" in p and " IN (" not in p for p in plans)


def test_count_sheets_of_a_folder(spark, tmp_path):
    (tmp_path / "Blue Lake.csv").write_text(',name,clean,intermediate,amalgamated,10,20.5\n,"pine, x", Pinus  s,conifer,tree,3,\n,,a,b,c,1,1\n')
    (tmp_path / "Red Bog_LIST.csv").write_text("name,clean,intermediate,amalgamated,depth,count\noak,oak,oak,tree,7,\noak,oak,oak,tree,8,2\n")
    names = ("site_name", "taxon_name", "clean", "depth", "count")
    zero = [("Blue Lake", "pine, x", "Pinus s", 10.0, 3.0), ("Blue Lake", "pine, x", "Pinus s", 20.5, 0.0), ("Red Bog", "oak", "oak", 7.0, None), ("Red Bog", "oak", "oak", 8.0, 2.0)]
    assert rows(files.read_count_sheets(spark, str(tmp_path)), *names) == zero
    dropped = rows(files.read_count_sheets(spark, str(tmp_path), null_policy="drop"), *names)
    assert ("Blue Lake", None, "a", 10.0, 1.0) in dropped and len(dropped) == 5
