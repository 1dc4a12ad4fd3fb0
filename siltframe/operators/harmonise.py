"""Bring an external source into archive columns, and link its records to ours."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import null_max, to_centimetres
from .aggregates import joined_text
from .joins import keep_members

DEFAULT_SOURCE = "NEOTOMA"


@dataclass(frozen=True)
class TableMapping:
    """How one table of a source becomes one of ours.

    ``rename`` is {source name: archive name}; ``centimetres`` lists archive columns stored in
    metres; ``scale`` lists those stored in metres without null codes; ``error`` names the two
    one-sided errors whose maximum becomes ``error``; ``drop`` lists what is not taken over.
    """

    rename: Mapping[str, str] = field(default_factory=dict)
    centimetres: tuple[str, ...] = ()
    scale: tuple[str, ...] = ()
    error: tuple[str, str] | None = None
    drop: tuple[str, ...] = ()

    def apply(self, df: DataFrame) -> DataFrame:
        df = df.drop(*self.drop).withColumnsRenamed(dict(self.rename))
        if self.error:
            df = df.withColumn("error", null_max(*[F.col(c) for c in self.error])).drop(*self.error)
        if self.centimetres:
            df = df.withColumns({c: to_centimetres(F.col(c)) for c in self.centimetres})
        if self.scale:
            df = df.withColumns({c: F.col(c) * 100 for c in self.scale})
        return df


def symmetric_error(df: DataFrame, positive: str, negative: str) -> DataFrame:
    return TableMapping(error=(positive, negative)).apply(df)


def collapse_publications(entity: DataFrame, entity_pub: DataFrame, pub: DataFrame) -> DataFrame:
    """Each entity once, with its citations joined by ";\\n" in publication order.

    An entity without a publication, or with one that has no citation, gets null.
    """
    cited = entity.select("ID_ENTITY").join(entity_pub, "ID_ENTITY", "left").join(pub, "ID_PUB", "left")
    text = joined_text(cited, ["ID_ENTITY"], ["ID_PUB"], "citation", "publication")
    return entity.join(text, "ID_ENTITY", "left")


def harmonise_source(
    tables: Mapping[str, DataFrame], mapping: Mapping[str, TableMapping], entities: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Metadata, dates, samples, models and counts of a source in archive columns.

    ``tables`` holds ``entity``, ``entity_pub``, ``pub`` and ``site`` and, where the source has them,
    ``date_info``, ``sample``, ``age_model`` and ``pollen``; ``entities`` selects by ID_ENTITY.
    """
    plain = TableMapping()

    def mapped(name: str) -> DataFrame:
        return mapping.get(name, plain).apply(tables[name])

    entity = mapped("entity")
    if entities is not None:
        entity = keep_members(entity, entities, "ID_ENTITY")
    cited = collapse_publications(entity, tables["entity_pub"], tables["pub"])
    out = {"metadata": cited.join(mapped("site"), "ID_SITE", "left")}
    if "date_info" in tables:
        out["date_info"] = keep_members(mapped("date_info"), entity, "ID_ENTITY")
    if "sample" in tables:
        sample = keep_members(mapped("sample"), entity, "ID_ENTITY")
        out["sample"] = sample.withColumnRenamed("ID_ENTITY", "external_ID_ENTITY")
        for name in ("age_model", "pollen"):
            if name in tables:
                # Every row of the source table that belongs to a kept sample, with that sample.
                out[name] = out["sample"].join(mapped(name), "ID_SAMPLE", "inner")
    return out


def external_links(entity: DataFrame, external: DataFrame, on: str, source: str) -> DataFrame:
    """Rows of the link table: every external record, with our ids where ``on`` finds them."""
    ours = entity.select("ID_SITE", "ID_ENTITY", on).distinct()
    return (
        external.join(ours, on, "left")
        .withColumn("external_source", F.lit(source))
        .select(
            "ID_SITE",
            "ID_ENTITY",
            "external_ID_SITE",
            "external_ID_ENTITY",
            "external_site_name",
            "external_entity_name",
            "external_source",
        )
    )


def links_from_legacy(legacy: DataFrame) -> DataFrame:
    """The older link table, which knew one source only, as rows of the present one."""
    renamed = {c: c.replace("neotoma_", "external_") for c in legacy.columns}
    return legacy.withColumnsRenamed(renamed).withColumn("external_source", F.lit(DEFAULT_SOURCE))


def default_source(entity: DataFrame, external_link: DataFrame) -> DataFrame:
    """Entities with each of their other sources, or the default one if there is none."""
    others = external_link.where(F.col("external_source") != DEFAULT_SOURCE).select("ID_ENTITY", "external_source")
    return entity.join(others, "ID_ENTITY", "left").na.fill(DEFAULT_SOURCE, ["external_source"])


def exclusive_source(external_link: DataFrame) -> DataFrame:
    """Links of the entities that have exactly one."""
    single = external_link.groupBy("ID_ENTITY").count().where(F.col("count") == 1)
    return external_link.join(single, "ID_ENTITY", "left_semi")


def get_links(external_link: DataFrame, *id_entity: int) -> DataFrame:
    return external_link.where(F.col("ID_ENTITY").isin(*id_entity))


def get_entity(entity: DataFrame, external_link: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Entities with their external links; an entity has one row per link, unlinked ones none."""
    if ids is not None:
        entity = keep_members(entity, ids, "ID_ENTITY")
    return entity.join(external_link, ["ID_SITE", "ID_ENTITY"])


def match_flag(df: DataFrame, external_id: str, name: str) -> DataFrame:
    """``name`` is true for records without a counterpart in the other archive."""
    return df.select(F.col(external_id).isNull().alias(name), "*")


def models_across_sources(
    external_link: DataFrame, other_sample: DataFrame, other_model: DataFrame, source: str
) -> DataFrame:
    """Age models of another archive for our entities, found through their external ids."""
    ours = external_link.where(F.col("external_source") == source).select("ID_ENTITY", "external_ID_ENTITY")
    renamed = other_sample.withColumnRenamed("ID_ENTITY", "external_ID_ENTITY")
    return ours.join(renamed, "external_ID_ENTITY").join(other_model, "ID_SAMPLE")
