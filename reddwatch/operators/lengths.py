"""Length frequency of adults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reddwatch import schemas
from reddwatch.functions.numeric import floor_bin, without_nan
from reddwatch.params import BIN_WIDTH


def measured_adults(individuals: DataFrame) -> DataFrame:
    return individuals.withColumn("length_mm", without_nan(F.col("length_mm"))).filter(
        (F.col("release_lifestage") == "Adult") & F.col("length_mm").isNotNull()
    )


def length_frequency(
    individuals: DataFrame, keys: Sequence[str] = (), width: int = BIN_WIDTH
) -> DataFrame:
    """Adults per length bin, with the sample size and mean length over all bins.

    The totals are summed over the bins, few rows whatever the number of individuals: by a
    window for each key, or by a scalar if there are none, where the filter on the bin sums drops
    nothing but keeps the plans of its two uses equal, so that Spark runs one exchange for them.
    """
    bins = (
        measured_adults(individuals)
        .groupBy(*keys, floor_bin("length_mm", width).alias("length_bin"))
        .agg(F.count(F.lit(1)).alias("freq"), F.sum("length_mm").alias("_length_sum"))
    )
    if not keys:
        bins = bins.filter(F.col("_length_sum").isNotNull())
        whole = bins.agg(F.struct(
            F.sum("freq").alias("total_sample"),
            (F.sum("_length_sum") / F.sum("freq")).alias("mean_length"),
        )).scalar()
        counted = bins.withColumn("_whole", whole).select("*", "_whole.*")
        return counted.select(*schemas.LENGTH_COLUMNS)
    over = W.partitionBy(*keys)
    total = F.sum("freq").over(over)
    return bins.withColumns({
        "total_sample": total,
        "mean_length": F.sum("_length_sum").over(over) / total,
    }).select(*schemas.LENGTH_COLUMNS, *keys)
