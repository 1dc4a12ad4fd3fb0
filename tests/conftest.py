import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siltframe.sources.tables import Archive, literal_table  # noqa: E402
from siltframe.testing import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """frame(schema, *rows): a small table."""
    return lambda schema, *rows: literal_table(spark, list(rows), schema)


@pytest.fixture(scope="session")
def archive(frame):
    """Four entities: complete, undated, without models, and empty; two share an entity name."""
    return Archive(
        entity=frame(
            "ID_SITE long, ID_ENTITY long, site_name string, entity_name string, latitude double",
            (1, 1, "Alpha", "A1", 50.0),
            (1, 2, "Alpha", "A2", 50.0),
            (2, 3, "Beta", "B1", -20.0),
            (3, 4, "Gamma", "A1", 0.0),
        ),
        external_link=frame(
            "ID_SITE long, ID_ENTITY long, external_ID_SITE long, external_ID_ENTITY long, "
            "external_site_name string, external_entity_name string, external_source string",
            (1, 1, 11, 101, "Alpha", "A1", "NEOTOMA"),
            (1, 1, None, 201, "ALPHA", "a1", "OTHER"),
            (2, 3, 12, 103, "Beta", "B1", "NEOTOMA"),
        ),
        date_info=frame(
            "ID_ENTITY long, ID_DATE_INFO long, date_type string, depth double",
            (1, 1, "AMS", 1.0),
            (1, 2, "AMS", 2.0),
            (3, 3, "AMS", 1.0),
        ),
        sample=frame(
            "ID_ENTITY long, ID_SAMPLE long, depth double",
            (1, 10, 1.0),
            (1, 11, 2.0),
            (2, 20, 1.0),
            (3, 30, 5.0),
        ),
        taxon_name=frame("ID_TAXON long, taxon_name string", (1, "pine"), (2, "oak"), (3, "tree")),
        pollen_count=frame(
            "ID_SAMPLE long, ID_TAXON long, amalgamation_level int, count double",
            (10, 1, 0, 3.0),
            (10, 2, 0, 0.0),
            (11, 2, 0, 4.0),
            (10, 3, 1, 3.0),
            (11, 3, 1, 4.0),
            (10, 3, 2, 3.0),
            (11, 3, 2, 4.0),
            (20, 1, 0, 7.0),
            (20, 3, 1, None),
        ),
        model_name=frame("ID_MODEL int, model_name string", (3, "linear"), (8, "BACON_INTCAL20")),
        age_model=frame(
            "ID_MODEL int, ID_SAMPLE long, mean int", (8, 10, 100), (3, 10, 110), (8, 11, 200), (8, 20, 50)
        ),
    )


def rows(df, *columns):
    """All rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
