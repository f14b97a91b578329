"""Shared plumbing for registered queries: stand-in input, output normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.operators.clean import build_merged
from demandflow.sources import fixtures

# Doubles are snapped to multiples of 2**-20 (about 1e-6).  The grid is dyadic on purpose:
# decimal rounding at 6 places turns exact ties such as 37.3953125 (means of minute-based
# hours) into engine-dependent results, while x * 2**20 is exact in binary and a true value
# can only sit on a dyadic tie if its denominator holds 2**21.
GRID = 1048576.0


def normalize(df: DataFrame) -> DataFrame:
    """Snap doubles to the 2**-20 grid (and turn -0.0 into 0.0) so that engines agree on
    the value hash."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            snapped = F.round(F.col(f.name).cast("double") * F.lit(GRID)) / F.lit(GRID)
            cols.append((snapped + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def merged(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """Item-grain merged table built by the library from the stand-in raw tables."""
    raw = fixtures.raw_tables(spark, sf_dir)
    return build_merged(raw["orders"], raw["order_items"], raw["products"], raw["customers"],
                        region_mapping=fixtures.state_regions(spark, sf_dir), **kw)
