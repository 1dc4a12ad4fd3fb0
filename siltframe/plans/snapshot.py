"""Everything linked to chosen sites or entities."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import keep_members
from ..operators.reshape import UNMAPPED, UNNAMED, to_wide_by_id
from ..schema import LEVELS
from ..session import scratch_path
from ..sources.tables import Archive, literal_table

# Which column of a key table selects, first present one first.
KEY_ORDER = ("ID_ENTITY", "ID_SITE", "entity_name", "site_name")


class NoRecords(LookupError):
    """No entity has any of the wanted keys."""


@dataclass(frozen=True)
class Snapshot:
    """Lazy tables of the selected entities; counts are long, and wide per level on request."""

    archive: Archive
    entity: DataFrame
    # Whether keys were given, so that the linked tables have to be reduced before anything else.
    selective: bool

    @cached_property
    def date_info(self) -> DataFrame:
        return self.archive.date_info.join(self.entity, "ID_ENTITY", "left_semi")

    @cached_property
    def sample(self) -> DataFrame:
        return self.archive.sample.join(self.entity, "ID_ENTITY", "left_semi")

    @cached_property
    def age_model(self) -> DataFrame:
        models = self.archive.age_model.join(self.sample, "ID_SAMPLE", "left_semi")
        return models.join(self.archive.model_name, "ID_MODEL", "left")

    @cached_property
    def facts(self) -> DataFrame:
        """Count rows that may belong to the selection: all of them unless keys were given."""
        counted = self.archive.pollen_count.where(F.col("count").isNotNull())
        return counted.join(self.sample, "ID_SAMPLE", "left_semi") if self.selective else counted

    @cached_property
    def stored_facts(self) -> DataFrame:
        """``facts`` written once, by level; headers and pivots of all levels read them from there."""
        path = scratch_path(self.entity.sparkSession, "facts")
        counted = self._of_samples(self.facts).select("ID_SAMPLE", "ID_TAXON", "count", "amalgamation_level")
        counted.write.partitionBy("amalgamation_level").parquet(path)
        return self.entity.sparkSession.read.schema(counted.schema).parquet(path)

    @property
    def counts(self) -> DataFrame:
        """(ID_SAMPLE, taxon_name, amalgamation_level, count) of all levels."""
        named = self._of_samples(self.facts).join(self.archive.taxon_name, "ID_TAXON", "left")
        return named.select("ID_SAMPLE", "taxon_name", "amalgamation_level", "count")

    def _of_samples(self, counts: DataFrame) -> DataFrame:
        """Leave out counts of samples the archive does not have; a selection has lost them already."""
        return counts if self.selective else counts.join(self.sample, "ID_SAMPLE", "left_semi")

    def long(self, level: str) -> DataFrame:
        at_level = F.col("amalgamation_level") == LEVELS.index(level)
        return self.counts.where(at_level).drop("amalgamation_level")

    @cached_property
    def taxa(self) -> dict[str, dict[str, int | None]]:
        """The taxa that occur at each level, {header: id} in code-point order; found in one pass.

        A taxon without a name is headed by its id, counts without a taxon by ``unmapped``.
        """
        used = self.stored_facts.select("amalgamation_level", "ID_TAXON").distinct()
        rows = used.join(self.archive.taxon_name.select("ID_TAXON", "taxon_name"), "ID_TAXON", "left").collect()
        found: dict[str, dict[str, int | None]] = {level: {} for level in LEVELS}
        for row in rows:
            named = found[LEVELS[row.amalgamation_level]]
            header = row.taxon_name or (UNMAPPED if row.ID_TAXON is None else UNNAMED.format(row.ID_TAXON))
            if header in named:
                raise ValueError(f"two taxa are called {header}")
            named[header] = row.ID_TAXON
        return {level: dict(sorted(named.items())) for level, named in found.items()}

    def wide(self, level: str) -> DataFrame:
        """One level wide: a row per sample, a column per taxon that occurs at the level.

        The pivot runs on ids and its columns are renamed, so no name is joined to the counts. Rows
        of a sample meet once: the key of the counts allows one per taxon, so no sample is large.
        """
        at_level = self.stored_facts.where(F.col("amalgamation_level") == LEVELS.index(level))
        return to_wide_by_id(at_level.repartition("ID_SAMPLE"), ["ID_SAMPLE"], "ID_TAXON", self.taxa[level])

    @property
    def pollen_count(self) -> dict[str, DataFrame]:
        """The three wide tables."""
        return {level: self.wide(level) for level in LEVELS}

    def stats(self) -> DataFrame:
        return snapshot_stats(self)


def _select_entities(archive: Archive, key: str, values: Iterable | DataFrame) -> DataFrame:
    entity = archive.entity
    if isinstance(values, DataFrame):
        return keep_members(entity, values, key).select(*entity.columns)
    wanted = [values] if isinstance(values, (str, int)) else list(values)
    kind = entity.schema[key].dataType.simpleString()
    listed = literal_table(entity.sparkSession, [(w,) for w in wanted], f"`{key}` {kind}")
    return keep_members(entity, listed, key).select(*entity.columns)


def snapshot(
    archive: Archive,
    keys: DataFrame | None = None,
    *,
    id_entity: Iterable[int] | int | None = None,
    id_site: Iterable[int] | int | None = None,
    entity_name: Iterable[str] | str | None = None,
    site_name: Iterable[str] | str | None = None,
    require_records: bool = False,
) -> Snapshot:
    """The archive restricted to chosen entities; without any key, to all of them.

    Keys come as values or as a table; of several, ID_ENTITY wins over ID_SITE, entity_name and
    site_name. ``require_records`` raises ``NoRecords`` instead of returning empty tables.
    """
    named = dict(zip(KEY_ORDER, (id_entity, id_site, entity_name, site_name)))
    given = [k for k in KEY_ORDER if named[k] is not None]
    if keys is not None:
        present = [k for k in KEY_ORDER if k in keys.columns]
        if not present:
            raise ValueError("the key table needs one of " + ", ".join(KEY_ORDER))
        entity = _select_entities(archive, present[0], keys)
    elif given:
        entity = _select_entities(archive, given[0], named[given[0]])
    else:
        entity = archive.entity
    if require_records and entity.isEmpty():
        raise NoRecords("No records were found!")

    return Snapshot(archive, entity, selective=keys is not None or bool(given))


def counted_levels(counts: DataFrame) -> DataFrame:
    """One row per sample with a value, flagging the levels it has values at."""
    def at(level: int) -> Column:
        return F.max(F.when(F.col("amalgamation_level") == level, 1).otherwise(0)).alias(f"level_{level}")

    present = counts.where(F.col("count").isNotNull())
    return present.groupBy("ID_SAMPLE").agg(*[at(i) for i in range(len(LEVELS))])


def levels_per_entity(counts: DataFrame, sample: DataFrame) -> DataFrame:
    """Samples with counts per entity and level; counts shrink to one row per sample first."""
    flags = counted_levels(counts)
    joined = flags.join(sample.select("ID_SAMPLE", "ID_ENTITY"), "ID_SAMPLE")
    return joined.groupBy("ID_ENTITY").agg(
        *[F.sum(f"level_{i}").alias(f"n_counts_{i}") for i in range(len(LEVELS))]
    )


def snapshot_stats(snap: Snapshot) -> DataFrame:
    """Per entity: rows of dates, samples and age models, and wide count rows per level."""
    models = snap.age_model.groupBy("ID_SAMPLE").agg(F.count("*").alias("n"))
    age_model = (
        models.join(snap.sample.select("ID_SAMPLE", "ID_ENTITY"), "ID_SAMPLE")
        .groupBy("ID_ENTITY")
        .agg(F.sum("n").alias("age_model"))
    )
    parts = [
        snap.date_info.groupBy("ID_ENTITY").agg(F.count("*").alias("dates")),
        snap.sample.groupBy("ID_ENTITY").agg(F.count("*").alias("samples")),
        age_model,
        levels_per_entity(snap.facts, snap.sample),
    ]
    stats = snap.entity.select("ID_SITE", "ID_ENTITY", "site_name", "entity_name")
    for part in parts:
        stats = stats.join(part, "ID_ENTITY", "left")
    counts = [F.coalesce(f"n_counts_{i}", F.lit(0)).alias(name) for i, name in enumerate(LEVELS)]
    return stats.select(
        "ID_SITE",
        "ID_ENTITY",
        "site_name",
        "entity_name",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("dates", "samples", "age_model")],
        F.struct(*counts).alias("pollen_counts"),
    )
