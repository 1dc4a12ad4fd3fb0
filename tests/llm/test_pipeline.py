import corpus_pipeline
import __spark_entry__ as contract

from siltframe.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in contract.queries() and set(ORACLES) <= set(QUERIES)


def test_stages_keep_columns_and_drop_what_they_should(spark, tmp_path):
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    plain = " ".join(f"word{i % 37}x{i}" for i in range(80))
    rows = [
        (0, "12 34", "en"), (1, None, "en"), (2, plain, "en"), (3, plain.replace(" ", "  "), "en"), (4, plain + " end", "en"),
        (5, f"Text before. {passage} text after", "en"), (6, "another clean document with its own words", "de"), (None, "clean without an id", "en"),
    ]
    docs = spark.createDataFrame([(*r, "s", 1, "own", 2.0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, score double")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "best_fit_packing":
            assert out.dtypes == docs.dtypes
            assert {r["lang_pred"] for r in out.collect()} == {"own"}
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r["doc_id"] for r in docs.collect()}
    assert kept["language_id"] == {2, 3, 4, 5, 6, None}
    assert kept["exact_dedup"] == {2, 4, 5, 6, None}
    assert kept["near_dedup"] == {2, 5, 6, None}
    assert kept["decontamination"] == kept["best_fit_packing"] == {2, 6, None}
