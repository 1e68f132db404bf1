"""Small literal tables."""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, schema: T.StructType, rows: Iterable[Sequence]) -> DataFrame:
    """A table of constants. Its size is known to Catalyst, unlike that of a parallelised list."""
    constants = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(schema, row, strict=True)])
        for row in rows
    ]
    empty = F.array().cast(T.ArrayType(schema))
    one = spark.range(0, 1, 1, 1)
    return one.select(F.inline(F.array(*constants) if constants else empty))
