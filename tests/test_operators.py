import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltframe.operators import agemodel, aggregates, amalgamate, changes, dates, harmonise, joins, match, quality, reshape
from siltframe.operators.changes import KeyViolation


# ---- joins --------------------------------------------------------------------------------------


def test_not_in_keeps_a_null_key(frame):
    df, listed = frame("k int", (1,), (None,)), frame("k int", (1,))
    assert rows(joins.drop_members(df, listed, "k")) == [(None,)]


def test_null_matches_null_only_where_asked(frame):
    a, b = frame("k int, x int", (None, 1), (2, 2)), frame("k int, y int", (None, 3), (9, 9))
    assert rows(a.join(b, "k")) == []
    assert rows(joins.join_null_safe(a, b, ["k"])) == [(None, 1, 3)]
    assert rows(joins.natural_join(a, b)) == [(2, 2, None), (None, 1, 3)]
    assert rows(joins.join_null_safe(a, b, ["k"], "full_outer")) == [(2, 2, None), (9, None, 9), (None, 1, 3)]
    assert rows(joins.join_null_safe(a, b, ["k"], "right")) == [(9, None, 9), (None, 1, 3)]


def test_natural_join_needs_a_shared_column(frame):
    with pytest.raises(ValueError):
        joins.natural_join(frame("a int", (1,)), frame("b int", (1,)))


# ---- aggregates ---------------------------------------------------------------------------------


def test_all_null_sum_is_zero(frame):
    df = frame("k int, v double", (1, None), (2, 1.5), (2, None))
    assert rows(df.groupBy("k").agg(aggregates.sum_or_zero("v"))) == [(1, 0.0), (2, 1.5)]


def test_first_row_is_taken_whole_with_null_order_last(frame):
    df = frame("k int, o int, v string", (1, None, "null"), (1, 2, "two"), (1, 1, None), (2, None, "only"))
    assert rows(aggregates.first_per_key(df, ["k"], ["o"])) == [(1, 1, None), (2, None, "only")]


def test_joined_text_keeps_repeats(frame):
    df = frame("e int, p int, c string", (1, 1, "A"), (1, 1, "A"))
    assert rows(aggregates.joined_text(df, ["e"], ["p"], "c", "pub")) == [(1, "A;\nA")]


def test_null_depths_of_an_entity_match(frame):
    df = frame("ID_ENTITY int, depth double", (1, None), (1, 2.0004), (2, None))
    other = frame("ID_ENTITY int, depth double, age int", (1, None, 10), (1, 2.0, 20))
    assert [r[-1] for r in rows(match.match_depth_rounded(df, other).select("ID_ENTITY", "depth", "age"))] == [20, 10, None]


def test_repeated_and_unknown_keys_are_refused(frame):
    table = frame("k int, v string", (1, "a"))
    twice = frame("k int, v string", (2, "x"), (2, "y"))
    with pytest.raises(changes.KeyViolation):
        changes.upsert(table, twice, ["k"])
    with pytest.raises(changes.KeyViolation):
        changes.append_unseen(table, twice, ["k"])
    with pytest.raises(changes.KeyViolation):
        changes.upsert(table, frame("k int, w string", (1, "x")), ["k"])
    grown = changes.append_unseen(table, frame("k int, v string, w string", (1, "b", "c"), (3, "d", "e")), ["k"])
    assert rows(grown) == [(1, "a"), (3, "d")]


def test_joined_text_is_null_if_any_text_is(frame):
    df = frame("e int, p int, c string", (1, 2, "B"), (1, 1, "A"), (2, 1, "A"), (2, 2, None))
    assert rows(aggregates.joined_text(df, ["e"], ["p"], "c", "pub")) == [(1, "A;\nB"), (2, None)]


def test_duplicates_group_nulls_together(frame):
    df = frame("k int", (None,), (None,), (3,))
    assert rows(aggregates.find_duplicates(df, ["k"])) == [(None, 2), (None, 2)]


def test_a_hot_key_loses_no_row(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, 7, id) AS k", "id AS v")
    assert aggregates.find_duplicates(df, ["k"]).count() == 3001
    assert quality.redundancy(df, "k", ["v"]).where("k = 7").first()["n_all"] == 3001
    counted = spark.range(9000).selectExpr("if(id % 3 = 0, 7, id) AS ID_SAMPLE")
    flagged = joins.exists_flag(spark.range(10).toDF("ID_SAMPLE"), counted, "ID_SAMPLE", "hit")
    assert flagged.count() == 10 and flagged.where("hit").count() == 6
    assert aggregates.first_per_key(df, ["k"], ["v"]).where("k = 7").first()["v"] == 0


# ---- reshape ------------------------------------------------------------------------------------


def test_long_wide_long_is_the_identity(frame):
    df = frame("ID_SAMPLE int, taxon string, count double", (1, "a b.c|d", 0.0), (1, "z", 2.0), (2, "z", 1.0))
    wide = reshape.to_wide(df, ["ID_SAMPLE"], "taxon")
    assert wide.columns == ["ID_SAMPLE", "a b.c|d", "z"]
    assert rows(wide) == [(1, 0.0, 2.0), (2, None, 1.0)]
    assert rows(reshape.to_long(wide, ["ID_SAMPLE"])) == rows(df)


def test_empty_taxa_and_columns(frame):
    long = frame("t string, count double", ("a", None), ("a", 0.0), ("b", None))
    assert rows(reshape.drop_empty_taxa(long, "t")) == [("a", 0.0), ("a", None)]
    wide = frame("i int, `x.y` double, z double", (1, None, 1.0), (2, None, None))
    assert reshape.drop_empty_columns(wide, ["i"]).columns == ["i", "z"]


@pytest.mark.parametrize("policy, want", [("zero", [("pine", 1.5, 2.0), ("pine", None, 0.0)]), ("drop", [("pine", 1.5, 2.0), (None, 1.5, 9.0)])])
def test_matrix_layout(frame, policy, want):
    matrix = frame("taxon_name string, `1.5` string, note string", ("pine", "2", "x"), (None, "9", None))
    assert rows(reshape.long_from_matrix(matrix, ["taxon_name"], policy)) == want


# ---- amalgamation -------------------------------------------------------------------------------

MAP = "raw_taxon string, clean_name string, intermediate string, amalgamated string"


@pytest.fixture
def taxa(frame):
    names = ["pinus", "picea", "conifer", "tree", "herb"]
    return frame("ID_TAXON long, taxon_name string", *[(i, n) for i, n in enumerate(names, 1)])


@pytest.fixture
def taxa_map(frame):
    return frame(
        MAP,
        ("P. sylvestris", "pinus", "conifer", "tree"),
        ("P. mugo", "pinus", "conifer", "tree"),
        ("P. abies", "picea", "conifer", "tree"),
        ("weed", "herb", None, None),
    )


def test_three_levels_conserve_the_total_and_report_what_is_unmapped(frame, taxa, taxa_map):
    raw = frame(
        "ID_SAMPLE long, raw_taxon string, count double",
        (1, "P. sylvestris", 2.0),
        (1, "P. mugo", 3.0),
        (1, "P. abies", 0.0),
        (1, "unheard of", 4.0),
        (2, "weed", 1.0),
        (2, "P. abies", None),
    )
    clean = amalgamate.amalgamate_clean(raw, taxa_map, taxa)
    assert rows(clean) == [(1, 1, 0, 5.0), (1, 2, 0, 0.0), (1, None, 0, 4.0), (2, 5, 0, 1.0)]
    inter = amalgamate.amalgamate_intermediate(clean, taxa_map, taxa)
    assert rows(inter) == [(1, 3, 1, 5.0), (1, None, 1, 4.0), (2, None, 1, 1.0)]
    top = amalgamate.amalgamate_amalgamated(inter, taxa_map, taxa)
    assert {df.agg(F.sum("count")).first()[0] for df in (clean, inter, top)} == {10.0}
    assert rows(amalgamate.unmapped(inter)) == [(1, 1, 4.0), (2, 1, 1.0)]
    at_once = amalgamate.amalgamate_levels(raw, taxa_map, taxa)
    assert rows(at_once.where("amalgamation_level = 0")) == rows(clean)
    assert rows(at_once.where("amalgamation_level = 2")) == [(1, 4, 2, 5.0), (1, None, 2, 4.0), (2, None, 2, 1.0)]


def test_a_map_with_two_parents_is_reported(frame, taxa_map):
    assert rows(amalgamate.map_conflicts(taxa_map, "clean_name", "intermediate")) == []
    forked = taxa_map.unionByName(frame(MAP, ("P. x", "pinus", "shrub", "tree")))
    assert rows(amalgamate.map_conflicts(forked, "clean_name", "intermediate")) == [("pinus", 2)]


def test_levels_are_all_there_and_gaps_are_found(archive):
    split = amalgamate.split_levels(archive.pollen_count.where("amalgamation_level = 0"))
    assert list(split) == ["clean", "intermediate", "amalgamated"]
    assert split["amalgamated"].count() == 0
    assert rows(amalgamate.incomplete_levels(archive.pollen_count, archive.sample)) == [(20, 1), (30, 0)]


# ---- matching -----------------------------------------------------------------------------------


def test_positional_match_falls_back_to_depth(frame):
    mine = frame("e int, s int, depth double", (1, 11, 1.0), (1, 12, 2.0), (2, 21, 1.0), (2, 22, 2.0))
    other = frame("e int, depth double, x string", (1, 7.0, "a"), (1, 9.0, "b"), (2, 2.0004, "c"), (3, 1.0, "d"))
    got = match.match_positional(mine, other, "e", ["depth", "s"], ["depth"])
    assert rows(got, "e", "s", "x_source", "matched_by") == [
        (1, 11, "a", "position"),
        (1, 12, "b", "position"),
        (2, 22, "c", "depth"),
        (3, None, "d", "depth"),
    ]


def test_rounded_depths(frame):
    mine, other = frame("ID_ENTITY int, depth double", (1, 1.0)), frame("ID_ENTITY int, depth double", (1, 1.0004), (1, 1.0006))
    assert rows(match.match_depth_rounded(mine, other)) == [(1, 1.0, 1.0004)]


def test_gate_blanks_columns_where_the_age_disagrees(frame):
    df = frame("a double, b double, c string", (100.0, 100.0, "x"), (100.0, 200.0, "y"), (None, 1.0, "z"))
    assert rows(match.gate_by_age(df, "a", "b", ["c"]), "c") == [("x",), (None,), (None,)]


# ---- age models ---------------------------------------------------------------------------------

FILE = "ID_ENTITY long, depths double, " + ", ".join(f"{s} double" for s in agemodel.STATISTICS)


def file_row(entity, depth, mean):
    return (entity, depth, mean, *[mean + i for i in range(5)])


def test_age_model_load(frame, archive):
    sample = archive.sample
    files = frame(
        FILE,
        file_row(1, 1.0, 12.9),
        file_row(1, 1.0, 12.9),
        file_row(1, 2.0005, -12.9),
        file_row(2, 1.01, 5.0),
        file_row(3, 5.0, 1.0),
        file_row(3, 6.0, 1.0),
        file_row(9, 1.0, 1.0),
    )
    report = rows(agemodel.age_model_qc(files, sample))
    assert report == [
        (1, True, None),
        (2, False, agemodel.WRONG_DEPTHS),
        (3, False, agemodel.WRONG_COUNT),
        (9, False, agemodel.WRONG_COUNT),
    ]
    new, _ = agemodel.accepted_rows(files, sample)
    assert rows(new, "ID_MODEL", "ID_SAMPLE", "mean", "median") == [(8, 10, 12, 12), (8, 11, -12, -12)]
    old = archive.age_model.select("*", *[F.lit(0).alias(c) for c in new.columns[3:]])
    loaded = agemodel.load_age_models(files, sample, old)
    assert rows(loaded, "ID_MODEL", "ID_SAMPLE", "mean") == [(3, 10, 110), (8, 10, 12), (8, 11, -12), (8, 20, 50)]


# ---- dates --------------------------------------------------------------------------------------


def test_prepare_dates(frame, archive):
    dated = frame(
        "ID_ENTITY long, date_type string, lab_num string, depth double, age_c14 double, age_calib double, error double",
        (1, "AMS", "a", 1.0, -999999.0, 7.0, 0.0),
        (3, "radiocarbon", "b", 2.0, 5.0, 9.0, None),
        (1, "Hiatus", "c", 3.0, 5.0, None, 1.0),
        (1, None, "d", 3.0, 5.0, None, 1.0),
        (1, "tephra", "e", 4.0, None, -777777.0, 1.0),
    )
    assert rows(dates.prepare_dates(dated, archive.entity)) == [(1, "a", 7.0, 1.0, 1.0, 1), (3, "b", 5.0, 1.0, 2.0, 3)]


def test_reviewed_reasons_are_routed(frame):
    schema = "i int, reason_age_not_used string, notes string, age_used string"
    df = frame(schema, (1, "see text", None, "yes"), (2, "see text", "kept", "yes"), (3, "bad", None, "yes"), (4, "odd ", None, None), (5, None, None, None))
    revised = frame("current string, new string, remark string", ("see text", "the text", "to notes"), ("bad", "bad", "reason only"), ("odd ", "odd", None))
    assert rows(dates.route_reasons(df, revised)) == [
        (1, None, "the text", "yes"),
        (2, None, "kept", "yes"),
        (3, None, None, "no"),
        (4, "odd", None, None),
        (5, None, None, None),
    ]


# ---- changes ------------------------------------------------------------------------------------


@pytest.fixture
def table(frame):
    return frame("k int, a string, b string", (1, "x", "y"), (2, "x", "y"))


@pytest.fixture
def updates(frame):
    return frame("k int, a string", (2, None), (3, "new"))


def test_upsert_sets_supplied_columns_and_is_idempotent(table, updates):
    once = changes.upsert(table, updates, ["k"])
    assert rows(once) == [(1, "x", "y"), (2, None, "y"), (3, "new", None)]
    assert rows(changes.upsert(once, updates, ["k"])) == rows(once)


def test_dry_run_names_what_the_upsert_changes(table, updates):
    assert rows(changes.change_set(table, updates, ["k"])) == [(2, "update"), (3, "insert")]
    done = changes.upsert(table, updates, ["k"])
    assert rows(quality.table_diff(table, done, ["k"]), "k", "status") == [(2, "changed"), (3, "added")]
    assert rows(changes.change_set(done, updates, ["k"])) == []
    assert (1, "delete") in rows(changes.change_set(table, updates, ["k"], delete_missing=True))


def test_append_checks_keys(frame, table):
    parent = frame("a string", ("x",))
    with pytest.raises(KeyViolation, match="existing key"):
        changes.append_records(table, frame("k int, a string", (1, "x")), ["k"])
    with pytest.raises(KeyViolation, match="repeated key"):
        changes.append_records(table, frame("k int, a string", (8, "x"), (8, "x")), ["k"])
    with pytest.raises(KeyViolation, match="null key"):
        changes.append_records(table, frame("k int, a string", (None, "x")), ["k"])
    with pytest.raises(KeyViolation, match="no parent"):
        changes.append_records(table, frame("k int, a string", (8, "q")), ["k"], {"a": parent})
    added = changes.append_records(table, frame("k int, a string", (8, "x")), ["k"], {"a": parent})
    assert (8, "x", None) in rows(added)


def test_deletes(frame, table, archive):
    kept, removed = changes.delete_where(frame("v int", (1,), (5,), (None,)), F.col("v") > 2)
    assert rows(kept) == [(1,), (None,)] and rows(removed) == [(5,)]
    assert rows(changes.delete_rows(table, table.where("k = 1"))) == [(2, "x", "y")]
    links = archive.external_link
    assert changes.delete_rows(links, links.where("external_source = 'OTHER'")).count() == 2
    left, before = changes.rm_links(links, 1, "OTHER")
    assert left.count() == 2 and before.count() == 2
    after = changes.cascade_delete(archive, frame("ID_ENTITY long", (1,)))
    assert [after.table(t).count() for t in ("entity", "external_link", "date_info", "sample", "pollen_count", "age_model")] == [3, 1, 1, 2, 2, 1]


def test_null_safe_split(frame):
    mine = frame("e int, d double", (1, None), (1, 1.0))
    existing, new = changes.split_existing_new(mine, frame("e int, d double", (1, None), (2, None)), ["e", "d"])
    assert rows(existing) == [(1, None)] and rows(new) == [(2, None)]


def test_resolved_duplicates_come_back_reviewed(frame, table):
    reviewed = frame("k int, a string, b string, keep int", (1, "r", "r", 0), (2, "r", "r", 1))
    assert rows(changes.resolve_duplicates(table, reviewed, "k")) == [(2, "r", "r")]


# ---- harmonising --------------------------------------------------------------------------------


def test_source_with_its_own_columns(frame):
    out = harmonise.harmonise_source(
        {
            "entity": frame("ID_ENTITY int, ID_SITE int, TYPE string", (1, 1, "core"), (2, 1, "core"), (3, 9, "core")),
            "entity_pub": frame("ID_ENTITY int, ID_PUB int", (1, 2), (1, 1), (2, 3)),
            "pub": frame("ID_PUB int, citation string", (1, "A"), (2, "B"), (3, None)),
            "site": frame("ID_SITE int, site_name string", (1, "Alpha")),
            "date_info": frame("ID_ENTITY int, avg_depth double, p double, m double", (1, 1.5, 3.0, 5.0), (2, -777777.0, None, 5.0), (7, 1.0, 1.0, 1.0)),
        },
        {
            "entity": harmonise.TableMapping(rename={"TYPE": "entity_type"}),
            "date_info": harmonise.TableMapping(rename={"avg_depth": "depth"}, centimetres=("depth",), error=("p", "m")),
        },
    )
    assert rows(out["metadata"], "ID_ENTITY", "entity_type", "publication", "site_name") == [
        (1, "core", "A;\nB", "Alpha"),
        (2, "core", None, "Alpha"),
        (3, "core", None, None),
    ]
    assert rows(out["date_info"], "ID_ENTITY", "depth", "error") == [(1, 150.0, 5.0), (2, -777777.0, None)]


def test_links_and_sources(archive):
    assert rows(harmonise.default_source(archive.entity, archive.external_link), "ID_ENTITY", "external_source") == [
        (1, "OTHER"),
        (2, "NEOTOMA"),
        (3, "NEOTOMA"),
        (4, "NEOTOMA"),
    ]
    assert rows(harmonise.exclusive_source(archive.external_link), "ID_ENTITY") == [(3,)]
    assert harmonise.get_entity(archive.entity, archive.external_link).count() == 3
    assert harmonise.get_links(archive.external_link, 1).count() == 2


# ---- checks -------------------------------------------------------------------------------------


def test_a_table_does_not_differ_from_itself(archive):
    assert rows(quality.table_diff(archive.pollen_count, archive.pollen_count, ["ID_SAMPLE", "ID_TAXON", "amalgamation_level"])) == []


def test_tolerance_and_one_sided_rows(frame):
    old = frame("k int, v double, t string", (1, 100.0, "a"), (2, 1.0, None), (3, 1.0, "x"))
    new = frame("k int, v double, t string", (1, 100.05, "a"), (2, None, "b"), (4, 1.0, "x"))
    assert rows(quality.table_diff(old, new, ["k"], 1e-3)) == [
        (2, "t", None, "b", "changed"),
        (2, "v", "1.0", None, "changed"),
        (3, None, None, None, "removed"),
        (4, None, None, None, "added"),
    ]
    assert rows(quality.table_diff(old, new, ["k"], 1e-9), "k")[0] == (1,)


def test_key_checks(frame, archive):
    assert rows(quality.check_pk(archive.age_model, ["ID_SAMPLE"])) == [(10, 2)]
    assert rows(quality.check_fk(archive.sample, archive.entity.where("ID_ENTITY > 1"), "ID_ENTITY"), "ID_SAMPLE") == [(10,), (11,)]
    hits = quality.existing_keys(archive.sample, frame("ID_ENTITY long, ID_SAMPLE long", (3, 99), (8, 20)), ["ID_ENTITY", "ID_SAMPLE"])
    assert rows(hits, "ID_SAMPLE") == [(20,), (30,)]


def test_duplicate_review_flags(frame):
    totals = frame("e string, depth double, total double", ("a", 1.0, 5.0), ("a", 1.0, 5.0), ("b", 1.0, 1.0), ("b", 1.0, 2.0), ("c", None, 1.0))
    got = quality.duplicate_review(totals, frame("e string", ("a",), ("c",)), "e")
    assert rows(got, "e", "same_total", "keep") == [("a", True, True), ("a", True, True), ("b", False, False), ("b", False, False), ("c", True, True)]


def test_unpaired_codes_ignore_blanks_and_hyphens(frame):
    a, b = frame("e int, lab_num string", (1, "X-1"), (1, "X-2")), frame("e int, lab_num string", (1, "x 1"), (1, "X 2"))
    assert rows(quality.unpaired_codes(a, b, "e")) == [(1, "X1", 1), (1, "x1", 1)]


def test_zero_thickness(frame):
    assert rows(quality.zero_thickness(frame("thickness double", (0.0001,), (0.5,), (None,)))) == [(0.5,), (None,), (None,)]
