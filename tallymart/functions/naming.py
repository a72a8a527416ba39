"""Header names: three normalisation modes and collision handling."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Characters that become an underscore in snake mode.
SNAKE_SEPARATORS = r"[ .\-/()\[\]_]+"


def _snake(name: str) -> str:
    return re.sub(SNAKE_SEPARATORS, "_", name.strip().lower()).strip("_")


# Fixed value: what strict mode keeps of a name.
STRICT_SEPARATORS = "[^0-9a-z]+"


def _strict(name: str) -> str:
    return re.sub(STRICT_SEPARATORS, "_", name.strip().lower())


def _lower(name: str) -> str:
    return name.strip().lower()


MODES = {"snake": _snake, "strict": _strict, "lower": _lower}


def normalize_names(names: list[str], mode: str = "snake") -> list[str]:
    """Normalised names; a name that is already taken gets ``_2``, ``_3``, ..."""
    taken: set[str] = set()
    result = []
    for position, name in enumerate(names):
        base = MODES[mode](name) or f"column_{position + 1}"
        candidate, n = base, 1
        while candidate in taken:
            n += 1
            candidate = f"{base}_{n}"
        taken.add(candidate)
        result.append(candidate)
    return result


def normalize_columns(df: DataFrame, mode: str = "snake") -> DataFrame:
    return df.toDF(*normalize_names(df.columns, mode))
