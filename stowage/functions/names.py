"""Column-name transforms applied to by-name loads."""

from __future__ import annotations

from collections.abc import Callable

import regex
from pyspark.sql import DataFrame

# A word starts at an upper-case letter that follows a lower-case one, or at
# the last upper-case letter of a run when a lower-case one comes next. Matches
# consume their letters, so neighbouring boundaries may be missed on purpose.
_WORD_START = regex.compile(r"(\p{Lu})(\p{Lu}\p{Ll})|(\p{Ll})(\p{Lu})")


def snake_case(name: str) -> str:
    """``someColumnName`` -> ``some_column_name``."""
    split = _WORD_START.sub(lambda m: f"{m[1] or m[3]}_{m[2] or m[4]}", name)
    return split.lower()


TRANSFORMS: dict[str, Callable[[str], str]] = {
    "none": lambda name: name,
    "snake_case": snake_case,
    "lower_case": str.lower,
    "upper_case": str.upper,
}


def transform_named(name: str) -> Callable[[str], str]:
    try:
        return TRANSFORMS[name.lower()]
    except KeyError:
        raise ValueError(f"unknown name transform {name!r}; known: {', '.join(TRANSFORMS)}") from None


def transformed_names(columns: list[str], transform: str) -> dict[str, str]:
    """Old name -> new name for every column; two columns must not meet."""
    apply = transform_named(transform)
    renamed = {c: apply(c) for c in columns}
    taken: dict[str, str] = {}
    for old, new in renamed.items():
        if new in taken:
            raise ValueError(f"columns {taken[new]!r} and {old!r} both become {new!r} under {transform}")
        taken[new] = old
    return renamed


def transform_columns(df: DataFrame, transform: str = "none") -> DataFrame:
    """Rename every column of ``df``; only the plan's output names change."""
    renamed = transformed_names(df.columns, transform)
    return df.toDF(*[renamed[c] for c in df.columns])
