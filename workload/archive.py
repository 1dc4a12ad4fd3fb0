"""The archive of ``views.py`` for Spark, read from the given Parquet tables.

Tables are built on demand; a ``Workload`` can be used wherever an archive is read.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltframe.operators.amalgamate import amalgamate_levels
from siltframe.session import configure
from siltframe.sources.tables import Archive, literal_table

# Declared, so that reading a table needs no pass over its footers.
GIVEN = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_returnflag STRING, "
    "l_linestatus STRING",
    "events": "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE",
}


class Workload:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def given(self, name: str) -> DataFrame:
        return self.spark.read.schema(GIVEN[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def archive(self) -> Archive:
        return Archive(
            self.entity,
            self.external_link,
            self.date_info,
            self.sample,
            self.taxon_name,
            self.pollen_count,
            self.model_name,
            self.age_model,
        )

    @cached_property
    def entity(self) -> DataFrame:
        nation = self.given("nation").withColumnRenamed("n_nationkey", "c_nationkey")
        return (
            self.given("customer")
            .join(nation, "c_nationkey")
            .selectExpr(
                "CAST(c_nationkey AS BIGINT) AS ID_SITE",
                "c_custkey AS ID_ENTITY",
                "n_name AS site_name",
                "c_name AS entity_name",
                "CAST(c_custkey % 140 - 60 AS DOUBLE) AS latitude",
                "CAST(c_custkey % 40 - 10 AS DOUBLE) AS longitude",
                "c_acctbal AS elevation",
                "CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'unknown' ELSE lower(c_mktsegment) END AS site_type",
                "if(c_custkey % 2 = 0, 'author  supplied', 'archive') AS source",
                "if(c_custkey % 5 = 0, NULL, concat('study ', c_custkey % 17)) AS publication",
                "if(c_custkey % 3 = 0, NULL, concat('10.1/', c_custkey)) AS doi",
            )
        )

    @cached_property
    def external_link(self) -> DataFrame:
        first = self.entity.selectExpr(
            "ID_SITE",
            "ID_ENTITY",
            "ID_SITE + 1000 AS external_ID_SITE",
            "ID_ENTITY + 10000 AS external_ID_ENTITY",
            "site_name AS external_site_name",
            "entity_name AS external_entity_name",
            "'NEOTOMA' AS external_source",
        )
        second = self.entity.where("ID_ENTITY % 3 = 0").selectExpr(
            "ID_SITE",
            "ID_ENTITY",
            "CAST(NULL AS BIGINT) AS external_ID_SITE",
            "ID_ENTITY + 20000 AS external_ID_ENTITY",
            "upper(site_name) AS external_site_name",
            "lower(entity_name) AS external_entity_name",
            "'OTHER' AS external_source",
        )
        return first.unionByName(second)

    @cached_property
    def date_info(self) -> DataFrame:
        return self.given("events").selectExpr(
            "user_id AS ID_ENTITY",
            "event_id AS ID_DATE_INFO",
            """CASE WHEN event_id % 77 = 0 THEN NULL WHEN event_type = 'click' THEN 'AMS radiocarbon'
                    WHEN event_type = 'view' THEN 'core top estimated' WHEN event_type = 'purchase' THEN 'pollen correlation'
                    WHEN event_type = 'signup' THEN 'Hiatus' ELSE 'unknown' END AS date_type""",
            "if(event_id % 11 = 0, NULL, value) AS depth",
            "CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN -777777D ELSE 1D END AS thickness",
            "concat('LAB - ', event_id % 97) AS lab_num",
            "CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN -999999D ELSE value * 10 END AS age_c14",
            "if(event_id % 3 = 0, NULL, value * 11) AS age_calib",
            "CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 0D ELSE value / 10 END AS error",
            """CASE event_id % 10 WHEN 0 THEN 'wood' WHEN 1 THEN ' bulk   sediment ' WHEN 2 THEN 'unknown material'
                    WHEN 3 THEN NULL ELSE 'peat' END AS material_dated""",
            """CASE WHEN event_id % 77 = 0 OR event_id % 9 = 0 THEN NULL WHEN event_id % 9 = 1 THEN 'unknown'
                    WHEN event_id % 9 = 2 THEN 'no' ELSE 'yes' END AS age_used""",
            """CASE event_id % 8 WHEN 0 THEN 'outlier' WHEN 1 THEN 'unknown reason' WHEN 2 THEN 'reversal '
                    WHEN 3 THEN 'see text' END AS reason_age_not_used""",
            "if(event_id % 13 = 0, 'checked', NULL) AS notes",
        )

    @cached_property
    def sample(self) -> DataFrame:
        age = "if(o_orderkey % 13 = 0, NULL, CAST(floor(o_totalprice / 50) AS INT))"
        return self.given("orders").selectExpr(
            "o_custkey AS ID_ENTITY",
            "o_orderkey AS ID_SAMPLE",
            "floor(o_totalprice) / 10 AS depth",
            "if(o_orderkey % 9 = 0, 0D, 1D) AS thickness",
            "concat('chron ', o_orderkey % 3) AS chronology_name",
            "if(o_orderstatus = 'P', NULL, o_orderpriority) AS age_type",
            f"{age} AS age",
            f"{age} - 50 AS age_younger",
            f"{age} + 50 AS age_older",
            "if(o_orderkey % 4 = 0, 'unknown', 'raw count') AS count_type",
            "if(o_orderkey % 6 = 0, NULL, 'pollen') AS sample_type",
        )

    @cached_property
    def source_sample(self) -> DataFrame:
        return self.sample.where("ID_SAMPLE % 10 <> 0").selectExpr(
            "ID_ENTITY",
            "depth + 0.0002D AS depth",
            "if(ID_SAMPLE % 9 = 0, 0.5D, thickness) AS thickness",
            "if(ID_SAMPLE % 4 = 0, age * 2, age) AS age",
            "chronology_name",
        )

    @cached_property
    def raw_count(self) -> DataFrame:
        return self.given("lineitem").selectExpr(
            "l_orderkey AS ID_SAMPLE",
            "l_partkey AS raw_taxon",
            "l_linenumber AS line",
            "concat(l_returnflag, '|', l_linestatus) AS element",
            """CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
                    WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 0D ELSE l_quantity END AS count""",
        )

    @cached_property
    def taxa_map(self) -> DataFrame:
        return (
            self.given("part")
            .where("p_size < 50")
            .selectExpr("p_partkey AS raw_taxon", "p_name AS clean_name", "split_part(p_name, ' ', 2) AS intermediate")
            .selectExpr("*", "if(intermediate < 'h', 'group a', 'group b') AS amalgamated")
        )

    @cached_property
    def taxon_name(self) -> DataFrame:
        # A taxon is numbered after the first map row and level that name it.
        names = self.taxa_map.selectExpr("raw_taxon", "posexplode(array(clean_name, intermediate, amalgamated)) AS (level, taxon_name)")
        return names.groupBy("taxon_name").agg(F.expr("min(raw_taxon * 3 + level)").alias("ID_TAXON")).select("ID_TAXON", "taxon_name")

    @cached_property
    def pollen_count(self) -> DataFrame:
        raw = self.raw_count.select("ID_SAMPLE", "raw_taxon", "count")
        return amalgamate_levels(raw, self.taxa_map, self.taxon_name).where("ID_TAXON IS NOT NULL")

    @cached_property
    def model_name(self) -> DataFrame:
        rows = [(3, "linear interpolation"), (8, "BACON_INTCAL20")]
        return literal_table(self.spark, rows, "ID_MODEL int, model_name string")

    @cached_property
    def age_model(self) -> DataFrame:
        return (
            self.sample.where("age_type IS NOT NULL AND age IS NOT NULL")
            .selectExpr("explode(if(ID_SAMPLE % 5 = 0, array(3, 8), array(8))) AS ID_MODEL", "ID_SAMPLE", "age")
            .selectExpr(
                "ID_MODEL",
                "ID_SAMPLE",
                "age AS mean",
                "age + ID_MODEL AS median",
                "age - 90 AS UNCERT_5",
                "age - 25 AS UNCERT_25",
                "age + 25 AS UNCERT_75",
                "age + 90 AS UNCERT_95",
            )
        )

    @cached_property
    def age_file(self) -> DataFrame:
        return (
            self.sample.where("NOT (ID_ENTITY % 10 = 0 AND ID_SAMPLE % 2 = 0)")
            .selectExpr("*", "explode(if(ID_SAMPLE % 10 = 0, array(1, 2), array(1))) AS copy")
            .selectExpr(
                "ID_ENTITY",
                "concat(copy, if(ID_SAMPLE % 7 = 0, ',', '-'), ID_SAMPLE) AS sample_ids",
                "if(ID_ENTITY % 10 = 1, depth + 0.01D, depth) AS depths",
                "age + 0.7D AS mean",
                "age + 0.2D AS median",
                "age - 90.9D AS uncert_5",
                "age - 25.5D AS uncert_25",
                "age + 25.5D AS uncert_75",
                "age + 90.9D AS uncert_95",
            )
        )

    @cached_property
    def entity_pub(self) -> DataFrame:
        return self.given("orders").selectExpr("o_custkey AS ID_ENTITY", "o_orderkey % 100 AS ID_PUB").distinct()

    @cached_property
    def pub(self) -> DataFrame:
        return self.given("supplier").selectExpr("s_suppkey AS ID_PUB", "if(s_suppkey % 31 = 0, NULL, s_name) AS citation")
