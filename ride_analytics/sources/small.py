"""Small tables from Python values, as local relations of known size."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def small_table(spark: SparkSession, rows: Iterable[Sequence], schema: str | T.StructType) -> DataFrame:
    """Spark knows the size of such a table and broadcasts it by its own
    threshold; a table built from a list of rows has no size and is shuffled."""
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    rows = [tuple(r) for r in rows]
    columns = list(zip(*rows)) if rows else [()] * len(struct)
    arrow = to_arrow_schema(struct)
    table = pa.Table.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, struct)
