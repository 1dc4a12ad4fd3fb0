"""Table schemas, keys and references of a sediment-core archive."""

from __future__ import annotations

from pyspark.sql import types as T

LEVELS = ("clean", "intermediate", "amalgamated")


def _struct(spec: str) -> T.StructType:
    kinds = {"id": T.LongType, "int": T.IntegerType, "num": T.DoubleType, "str": T.StringType}
    fields = (part.split(":") for part in spec.split())
    return T.StructType([T.StructField(name, kinds[kind](), True) for name, kind in fields])


# Ids are 64-bit: a fact table of this size outgrows 32 bits.
SCHEMAS: dict[str, T.StructType] = {
    "entity": _struct(
        "ID_SITE:id ID_ENTITY:id site_name:str entity_name:str latitude:num longitude:num "
        "elevation:num site_type:str source:str publication:str doi:str"
    ),
    "external_link": _struct(
        "ID_SITE:id ID_ENTITY:id external_ID_SITE:id external_ID_ENTITY:id "
        "external_site_name:str external_entity_name:str external_source:str"
    ),
    "date_info": _struct(
        "ID_ENTITY:id ID_DATE_INFO:id date_type:str depth:num thickness:num lab_num:str age_c14:num "
        "age_calib:num error:num material_dated:str age_used:str reason_age_not_used:str notes:str"
    ),
    "sample": _struct(
        "ID_ENTITY:id ID_SAMPLE:id depth:num thickness:num chronology_name:str age_type:str age:int "
        "age_younger:int age_older:int count_type:str sample_type:str"
    ),
    "taxon_name": _struct("ID_TAXON:id taxon_name:str"),
    "pollen_count": _struct("ID_SAMPLE:id ID_TAXON:id amalgamation_level:int count:num"),
    "model_name": _struct("ID_MODEL:int model_name:str"),
    "age_model": _struct(
        "ID_MODEL:int ID_SAMPLE:id mean:int median:int UNCERT_5:int UNCERT_25:int UNCERT_75:int UNCERT_95:int"
    ),
}

# The older form of the link table, kept readable for archives written before external_link.
LEGACY_LINK_SCHEMA = _struct(
    "ID_SITE:id ID_ENTITY:id neotoma_ID_SITE:id neotoma_ID_ENTITY:id neotoma_site_name:str neotoma_entity_name:str"
)

TABLES = tuple(SCHEMAS)

PRIMARY_KEYS: dict[str, list[str]] = {
    "entity": ["ID_ENTITY", "ID_SITE"],
    "external_link": ["ID_ENTITY", "external_ID_ENTITY", "external_source"],
    "date_info": ["ID_DATE_INFO"],
    "sample": ["ID_SAMPLE"],
    "taxon_name": ["ID_TAXON"],
    "pollen_count": ["ID_SAMPLE", "ID_TAXON", "amalgamation_level"],
    "model_name": ["ID_MODEL"],
    "age_model": ["ID_MODEL", "ID_SAMPLE"],
}

# child table -> [(parent table, shared key)]
FOREIGN_KEYS: dict[str, list[tuple[str, str]]] = {
    "external_link": [("entity", "ID_ENTITY")],
    "date_info": [("entity", "ID_ENTITY")],
    "sample": [("entity", "ID_ENTITY")],
    "pollen_count": [("sample", "ID_SAMPLE"), ("taxon_name", "ID_TAXON")],
    "age_model": [("sample", "ID_SAMPLE"), ("model_name", "ID_MODEL")],
}

# The age-model names every new archive starts with.
MODEL_NAMES: list[tuple[int, str]] = [
    (1, "original_age_model_clean"),
    (2, "polynomial interpolation"),
    (3, "linear interpolation"),
    (4, "-777777"),
    (5, "smoothing spline interpolation"),
    (6, "other"),
    (7, "BACON_INTCAL13"),
    (8, "BACON_INTCAL20"),
    (9, "-999999"),
    (10, "Fairbanks0107"),
    (11, "CalPal 2007 HULU curve"),
    (12, "Calib 5.0.2"),
    (13, "Clam2.2_INTCAL13"),
    (14, "OxCal P_Sequence"),
    (15, "layer counting"),
    (16, "mixed effects regression"),
    (17, "CLAM"),
    (18, "Poisson-process Bayesian model"),
]

# Fixed value: the model that loaded age-depth files are stored under.
DEFAULT_MODEL = 8
