"""Raw daily observations: one file per split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from restock import schema as S

# The files carry no split and hold the date as text.
FILE_SCHEMA = StructType(
    [
        StructField("dt", StringType()) if field.name == "dt" else field
        for field in S.OBSERVATION
        if field.name != "source_split"
    ]
)


def normalise(df: DataFrame, split: str) -> DataFrame:
    """Tag rows with their split, parse the date and put the columns in table order."""
    tagged = df.withColumn("source_split", F.lit(split))
    return tagged.select(*[tagged[field.name].cast(field.dataType) for field in S.OBSERVATION])


def read_observations(spark: SparkSession, folder: str) -> DataFrame:
    """``train.parquet`` and ``eval.parquet`` of a folder as one table.

    The files' own types are read (their flags may be stored as 64-bit) and cast afterwards.
    """
    train, evaluation = (normalise(spark.read.parquet(f"{folder}/{split}.parquet"), split) for split in S.SPLITS)
    return train.unionByName(evaluation)


def write_observation_files(obs: DataFrame, folder: str) -> None:
    """Write observations in the layout :func:`read_observations` takes."""
    for split in S.SPLITS:
        rows = obs.filter(F.col("source_split") == split).withColumn("dt", F.date_format("dt", "yyyy-MM-dd"))
        rows.select(*FILE_SCHEMA.names).write.mode("overwrite").parquet(f"{folder}/{split}.parquet")
