"""Facts carried by a bronze file's path ``<root>/YYYY/MM/<slug>-<start>_<end>.json``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layout of bronze paths.
SLUG = "[a-z0-9-]+"
DAY = r"\d{4}-\d{2}-\d{2}"
BRONZE_PATH = rf"/(\d{{4}})/(\d{{2}})/({SLUG})-({DAY})_({DAY})\.json$"
BRONZE_GLOB_DAY = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"
BRONZE_GLOB_DIR = "[0-9][0-9][0-9][0-9]/[0-9][0-9]"


def path_part(path: str | Column, group: int) -> Column:
    """One capture group of ``BRONZE_PATH``; NULL when the path has another shape."""
    c = F.col(path) if isinstance(path, str) else path
    return F.nullif(F.regexp_extract(c, BRONZE_PATH, group), F.lit(""))


def bronze_path_fields(path: str | Column) -> dict[str, Column]:
    """Slug, year, month and period of a bronze path, all NULL when it is not one."""
    return {
        "dataset_slug": path_part(path, 3),
        "year": path_part(path, 1).try_cast("int"),
        "month": path_part(path, 2).try_cast("int"),
        "period_start": path_part(path, 4).try_cast("date"),
        "period_end": path_part(path, 5).try_cast("date"),
    }
