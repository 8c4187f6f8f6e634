"""Reading a day's dump from headered CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv_dump(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    *,
    check_header: bool = True,
    malformed_column: str | None = None,
    **options: str,
) -> DataFrame:
    """A dump under a fixed schema; nothing is inferred.

    CSV binds by position, so a header in another order is an error when the rows
    are read, unless ``check_header=False``. Short lines are filled with nulls and
    surplus fields dropped; ``malformed_column`` keeps the text of such lines in a
    column of that name. Further Spark CSV options pass through.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if malformed_column:
        schema = T.StructType([*schema.fields, T.StructField(malformed_column, T.StringType())])
        options["columnNameOfCorruptRecord"] = malformed_column
    reader = spark.read.option("header", True).option("enforceSchema", not check_header)
    return reader.options(**options).schema(schema).csv(path)
