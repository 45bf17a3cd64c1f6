"""Column naming rules. Names are schema metadata, so this is plain Python over ``df.columns``."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import DataFrame


def snake_name(raw: str) -> str:
    """ASCII snake_case form of ``raw``; never empty and never starting with a digit."""
    ascii_text = unicodedata.normalize("NFKD", raw).encode("ascii", "ignore").decode("ascii")
    name = "_".join(re.findall(r"[0-9a-z]+", ascii_text.lower())) or "column"
    return "col_" + name if name[0].isdigit() else name


def unique_names(names: Iterable[str], reserved: Iterable[str] = ()) -> list[str]:
    """Number repeats ``x, x_2, x_3, …``, skipping any suffix that is itself taken or reserved.

    A name that is unique as given keeps its spelling, so an ``x_2`` already in the input is not
    displaced by the second ``x``.
    """
    names = list(names)
    reserved = set(reserved)
    taken = set(reserved)
    given = set(names)
    first_use = given - reserved
    out = []
    for name in names:
        if name in first_use:
            first_use.discard(name)
            candidate = name
        else:
            n = 2
            while (candidate := f"{name}_{n}") in taken or candidate in given:
                n += 1
        taken.add(candidate)
        out.append(candidate)
    return out


def with_clean_names(df: DataFrame, reserved: Iterable[str] = ()) -> DataFrame:
    """Clean every column name. A clean name found in ``reserved`` becomes ``raw_<name>``.

    Names are worked out first and applied by position, so two columns whose clean forms agree are
    told apart instead of both being renamed.
    """
    reserved = set(reserved)
    clean = [f"raw_{n}" if n in reserved else n for n in map(snake_name, df.columns)]
    return df.toDF(*unique_names(clean, reserved))


def with_prefix(df: DataFrame, prefix: str, keys: Iterable[str]) -> DataFrame:
    """Prefix the clean form of every non-key column with ``<prefix>_``, in one projection."""
    keys = set(keys)
    names = unique_names(c if c in keys else f"{prefix}_{snake_name(c)}" for c in df.columns)
    return df.toDF(*names)


def label_columns(columns: Iterable[str]) -> list[str]:
    return sorted(c for c in columns if c.startswith("label_"))


def first_label(columns: Iterable[str]) -> str:
    """The label column used when the caller names none."""
    labels = label_columns(columns)
    if not labels:
        raise ValueError("the table has no label_* column")
    return labels[0]


def drop_other_labels(df: DataFrame, label: str) -> DataFrame:
    return df.drop(*[c for c in label_columns(df.columns) if c != label])


def pivot_names(prefix: str, categories: Iterable, reserved: Iterable[str]) -> list[str]:
    """Output names of pivot cells, in category order; NULL is spelled ``null``.

    ``reserved`` holds the aggregate columns beside the pivot, so a category called e.g. ``total``
    gets a suffix instead of colliding.
    """
    return unique_names(
        (f"{prefix}_{snake_name('null' if c is None else str(c))}" for c in categories), reserved
    )

