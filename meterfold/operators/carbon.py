"""Carbon emission of consumption."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the name of the electricity emission coefficient among a plant's parameters.
ELECTRICITY_COEFFICIENT = "電力碳排係數"


def _one_coefficient(param: DataFrame, keys: list[str]) -> DataFrame:
    """One coefficient per key: of several parameters the one with the lowest id, or name where ids are not kept."""
    order = [c for c in ("param_id", "param_name", "float_value") if c in param.columns]
    return param.groupBy(*keys).agg(F.min_by("float_value", F.struct(*order)).alias("_coeff"))


def carbon_by_device_type(df: DataFrame, param: DataFrame, consumption: str = "consumption") -> DataFrame:
    """Add ``kgco2e`` from the plant's coefficient of the utility; NULL where it has none.

    Parameters need not be unique on plant and utility; a row of ``df`` stays one row.
    """
    return (
        df.join(_one_coefficient(param, ["factory_id", "device_type"]), ["factory_id", "device_type"], "left")
        .withColumn("kgco2e", F.col(consumption) * F.col("_coeff"))
        .drop("_coeff")
    )


def carbon_by_param_name(
    df: DataFrame, param: DataFrame, name: str = ELECTRICITY_COEFFICIENT, consumption: str = "consumption"
) -> DataFrame:
    """Add ``kgco2e`` from a plant's named coefficient; plants without it give no rows."""
    named = param.filter(F.col("param_name") == name)
    return (
        df.join(_one_coefficient(named, ["factory_id"]), "factory_id")
        .withColumn("kgco2e", F.col(consumption) * F.col("_coeff"))
        .drop("_coeff")
    )
