"""Text normalisation."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and the plain letters they are matched as.
_ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿčďěňřšťůžąćęłńśźżđğışőű"
_PLAIN = "aaaaaaceeeeiiiinoooooouuuuyycdenrstuzacelnszzdgisou"


def squish(c: Column) -> Column:
    """Trim, and collapse every run of whitespace to one blank."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean_name(c: Column) -> Column:
    """A matching form of a name: lower case, no accents, letters and digits only."""
    folded = F.translate(F.lower(c), _ACCENTED, _PLAIN)
    return F.regexp_replace(folded, "[^a-z0-9]", "")


def strip_code(c: Column) -> Column:
    """A laboratory code without blanks and hyphens."""
    return F.regexp_replace(squish(c), r"[\s-]", "")


def null_text(c: Column) -> Column:
    """The word NULL read from a text file becomes a real null."""
    return F.nullif(c, F.lit("NULL"))


def snake_case(names: Sequence[str]) -> list[str]:
    """Header names in lower snake case; a repeated name gets its column position as suffix."""
    plain = [
        re.sub(r"[^0-9a-z]+", "_", re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", n).lower()).strip("_") or "x"
        for n in names
    ]
    seen: dict[str, int] = {n: plain.count(n) for n in plain}
    return [f"{n}_{i}" if seen[n] > 1 else n for i, n in enumerate(plain, start=1)]
