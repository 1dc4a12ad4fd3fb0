"""Texts and tables that several tests share."""

import pytest

LONG = "word" * 20 + " " + " ".join(f"w{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def docs(frame):
    """docs(*texts): documents 0, 1, 2 ... with columns whose names clash with those of results."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, label string, row int"
    return lambda *texts, ids=None: frame(
        schema, *[((ids or range(len(texts)))[i], t, "en", "s", None, "x", None, 1) for i, t in enumerate(texts)]
    )
