"""Check and load age-depth model files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse_flag
from ..schema import DEFAULT_MODEL, SCHEMAS
from .changes import replace_slice
from .ids import pair_by_position

STATISTICS = ["mean", "median", "uncert_5", "uncert_25", "uncert_75", "uncert_95"]
DEPTH_TOLERANCE = 0.001
WRONG_COUNT = "Mismatch in the number of samples."
WRONG_DEPTHS = "Mismatch in the depths."


def _paired(files: DataFrame, sample: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Row counts per entity in the files, and file rows aligned with samples by depth order."""
    rows = files.select("ID_ENTITY", "depths", *STATISTICS).distinct()
    n_file = rows.groupBy("ID_ENTITY").agg(F.count("*").alias("n_file"))
    n_sample = sample.groupBy("ID_ENTITY").agg(F.count("*").alias("n_sample"))
    counts = n_file.join(n_sample, "ID_ENTITY", "left").na.fill(0, ["n_sample"])
    equal = counts.where(F.col("n_file") == F.col("n_sample")).select("ID_ENTITY")
    pairs = pair_by_position(
        rows.join(equal, "ID_ENTITY", "left_semi"),
        sample.select("ID_ENTITY", "ID_SAMPLE", "depth").join(equal, "ID_ENTITY", "left_semi"),
        ["ID_ENTITY"],
        ["depths", *STATISTICS],
        ["depth", "ID_SAMPLE"],
    )
    return counts, pairs.select("l.*", "r.ID_SAMPLE", "r.depth")


def _report(counts: DataFrame, paired: DataFrame) -> DataFrame:
    gap = F.abs(F.col("depths") - F.col("depth"))
    # A missing depth on either side is a mismatch too.
    off = F.max(F.coalesce(gap > DEPTH_TOLERANCE, F.lit(True))).alias("depths_differ")
    checked = counts.join(paired.groupBy("ID_ENTITY").agg(off), "ID_ENTITY", "left")
    reason = F.when(F.col("n_file") != F.col("n_sample"), WRONG_COUNT).when(F.col("depths_differ"), WRONG_DEPTHS)
    return checked.withColumn("reason", reason).select(
        "ID_ENTITY", F.col("reason").isNull().alias("status"), "reason"
    )


def age_model_qc(files: DataFrame, sample: DataFrame) -> DataFrame:
    """One row per entity with a file: (ID_ENTITY, status, reason)."""
    return _report(*_paired(files, sample))


def accepted_rows(files: DataFrame, sample: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of the accepted files as archive rows, and the accepted entities."""
    counts, paired = _paired(files, sample)
    accepted = _report(counts, paired).where("status").select("ID_ENTITY")
    # The integer cast truncates towards zero.
    ints = [F.col(s).cast("int").alias(s.replace("uncert", "UNCERT")) for s in STATISTICS]
    rows = paired.join(accepted, "ID_ENTITY", "left_semi").select(
        F.lit(DEFAULT_MODEL).alias("ID_MODEL"), "ID_SAMPLE", *ints
    )
    return rows.select(*SCHEMAS["age_model"].names), accepted


def load_age_models(files: DataFrame, sample: DataFrame, age_model: DataFrame) -> DataFrame:
    """The age-model table after loading: accepted entities have their default model replaced."""
    rows, accepted = accepted_rows(files, sample)
    slots = (
        sample.join(accepted, "ID_ENTITY", "left_semi")
        .select("ID_SAMPLE")
        .withColumn("ID_MODEL", F.lit(DEFAULT_MODEL))
    )
    return replace_slice(age_model, slots, rows, ["ID_MODEL", "ID_SAMPLE"])


def age_models_ready(
    review: DataFrame, rejected_names: Sequence[str] = (), elsewhere: str = "can be extracted from"
) -> tuple[DataFrame, DataFrame]:
    """Split a review sheet: models ready to load, and models still to be handled.

    The second set leaves out ignored rows, rows that another archive provides, rows with a single
    date and the named entities; a null in any tested column leaves a row out as well.
    """
    flagged = review.withColumn("ready", parse_flag(F.col("ready_to_upload")))
    ready = flagged.where("ready")
    pending = flagged.where(
        ~F.lower("ready_to_upload").rlike("ignore")
        & F.col("ready").isNull()
        & ~F.col("run_status").rlike(elsewhere)
        & ~F.col("run_status").rlike("one date")
    )
    if rejected_names:
        pending = pending.where(~F.col("entity_name").isin(*rejected_names))
    return ready, pending
