"""Column names that need no quoting."""

from __future__ import annotations

import warnings
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def quoted(name: str) -> str:
    """The name as one step of a column path, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def exactly(names: Iterable[str]) -> list[Column]:
    """Columns of these names; dots and spaces are part of a name."""
    return [F.col(quoted(n)) for n in names]


def legal_name(name: str) -> str:
    """Lower case, illegal characters as ``_``, starting with a letter."""
    cleaned = "".join(ch if ch.isalnum() or ch == "_" else "_" for ch in name)
    if not cleaned[:1].isalpha():
        cleaned = "x" + cleaned
    return cleaned.lower()


def friendly_names(names: list[str]) -> list[str]:
    """Legal names in the same order; repeats get ``_2``, ``_3``, ...

    A number that would collide with another column's name is skipped.
    """
    legal = [legal_name(n) for n in names]
    taken = set(legal)
    seen: Counter[str] = Counter()
    result = []
    changed = 0
    for name in legal:
        seen[name] += 1
        if seen[name] > 1:
            changed += 1
            while f"{name}_{seen[name]}" in taken:
                seen[name] += 1
            name = f"{name}_{seen[name]}"
            taken.add(name)
        result.append(name)
    if changed:
        warnings.warn(f"{changed} repeated column names were numbered", stacklevel=2)
    return result


def with_friendly_names(df: DataFrame) -> DataFrame:
    return df.toDF(*friendly_names(df.columns))
