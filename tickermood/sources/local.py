"""Small frames from literal rows."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def small_frame(spark: SparkSession, rows, schema: StructType) -> DataFrame:
    """Literal rows as a local relation, whose exact size Spark knows.

    A frame made from a Python list has no size estimate, so Spark would shuffle
    both sides of a join with it; a small Arrow table joins by broadcast.
    """
    rows = list(rows)
    columns = {f.name: pa.array([r[i] for r in rows]) for i, f in enumerate(schema.fields)}
    if not rows:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(pa.table(columns), schema)
