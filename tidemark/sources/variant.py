"""Bronze drops without a declared schema, parsed once.

Each drop is read whole as a VARIANT, which keeps types beside the values. Its elements are written to the shared
folder, and the aggregate of their schemas is observed while they are. Rows of that schema are then taken from the
written values: no drop is read or parsed a second time.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from tidemark.session import scratch_path
from tidemark.sources.bronze import _RAW_CORRUPT, bronze_glob, readable, with_provenance

# Types of values as text; a name before a colon is a column's.
_QUOTED = re.compile(r"(`(?:[^`]|``)*`)")
_FRACTION = re.compile(r"\bDECIMAL\(\d+,\s*([1-9]\d*)\)(?!\s*:)")
_NAMED = {r"\bOBJECT(?=<)": "STRUCT", r"\b(VOID|VARIANT)\b(?!\s*:)": "STRING", r"\bSTRUCT<>": "STRING"}


def column_types(found: str | None) -> StructType:
    """The columns of rows whose VARIANT schema, over all rows, is ``found``. Fractions are doubles; a column of
    NULLs, or of values without a common type, is text."""
    if not found or not found.startswith("OBJECT<"):
        return StructType()
    parts = _QUOTED.split(found)
    for i in range(0, len(parts), 2):
        parts[i] = _FRACTION.sub("DOUBLE", parts[i])
        for pattern, name in _NAMED.items():
            parts[i] = re.sub(pattern, name, parts[i])
    whole = "".join(parts)
    if whole == "STRING":  # no columns at all
        return StructType()
    return StructType.fromDDL(whole.removeprefix("STRUCT<").removesuffix(">"))


def type_text(kind: DataType) -> str:
    """A type as text that can be parsed, whatever its fields are called."""
    if isinstance(kind, StructType):
        fields = (f"`{f.name.replace('`', '``')}`:{type_text(f.dataType)}" for f in kind)
        return f"struct<{','.join(fields)}>"
    return f"array<{type_text(kind.elementType)}>" if isinstance(kind, ArrayType) else kind.simpleString()


def is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "struct<_:string>").isNotNull()


def member(row: Column, name: str, kind: str) -> Column:
    """The value of key ``name`` of an object; NULL where it has none."""
    if name and '"' not in name:
        return F.try_variant_get(row, f'$["{name}"]', kind)
    return F.try_variant_get(row.try_cast("map<string,variant>")[name], "$", kind)


def stage_bronze(spark: SparkSession, root: str, slug: str, paths: Sequence[str] = ()) -> tuple[str, StructType]:
    """Parse all drops of a dataset (or those of ``paths``) into a new folder of the shared folder: a row
    (_row variant, _path, corrupt text) for each element. Returns the folder and the columns that were found.

    A drop is an object or an array of objects; any other is one row with its text and no value.
    """
    reader = spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
    reader = reader.option("singleVariantColumn", "_doc").option("columnNameOfCorruptRecord", _RAW_CORRUPT)
    raw = reader.schema(f"_doc variant, {_RAW_CORRUPT} string").json(list(paths) or bronze_glob(root, slug))
    elements = F.coalesce(F.col("_doc").try_cast("array<variant>"), F.array("_doc"))
    docs = raw.select(_RAW_CORRUPT, "_doc", elements.alias("_rows"), raw.metadataColumn("_metadata").getField("file_path").alias("_path"))
    odd = F.col("_doc").isNotNull() & F.exists("_rows", lambda e: ~is_object(e))
    docs = docs.withColumn(_RAW_CORRUPT, F.when(odd, F.to_json("_doc")).otherwise(F.col(_RAW_CORRUPT)))
    rows = docs.withColumn("_rows", F.when(F.col(_RAW_CORRUPT).isNull(), F.col("_rows")).otherwise(F.array(F.lit(None).cast("variant"))))
    rows = rows.select(F.explode("_rows").alias("_row"), "_path", _RAW_CORRUPT)
    folder, seen = scratch_path(spark, "variant"), Observation()
    rows.observe(seen, F.schema_of_variant_agg("_row").alias("schema")).write.parquet(folder)
    return folder, column_types(seen.get["schema"])


def staged_rows(spark: SparkSession, folder: str, slug: str, schema: StructType) -> DataFrame:
    """What ``stage_bronze`` wrote, as ``read_bronze(corrupt=True)`` gives it."""
    staged = spark.read.schema(f"_row variant, _path string, {_RAW_CORRUPT} string").parquet(folder)
    values = [member(F.col("_row"), f.name, type_text(f.dataType)).alias(f.name) for f in schema]
    return with_provenance(staged.select(*values, _RAW_CORRUPT, "_path"), slug)


def read_bronze_once(spark: SparkSession, root: str, slug: str, corrupt: bool = False, paths: Sequence[str] = ()) -> DataFrame:
    """``read_bronze`` for a dataset without a declared schema, with one pass over its drops. Runs that pass.

    Types are those that inference finds, but for a column of text and numbers, whose numbers are spelled as
    VARIANT spells them. A drop has the size limit of a VARIANT, 128 MiB; a larger one counts as one that
    cannot be read (declare a schema for it).
    """
    folder, schema = stage_bronze(spark, root, slug, paths)
    df = staged_rows(spark, folder, slug, schema)
    return df if corrupt else readable(df)
