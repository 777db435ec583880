"""Writing stages, final sets, vocabularies and predictions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Paths:
    """Where a run keeps its files; everything lives below one folder all executors can reach."""

    root: str

    def at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def stage(self, name: str) -> str:
        return self.at("stages", name)

    def final(self, name: str) -> str:
        return self.at("data_for_modelling", name)

    def vocabulary(self, name: str) -> str:
        return self.at("vocabularies", name)

    def model(self, name: str) -> str:
        return self.at("models", name)

    def result(self, name: str) -> str:
        return self.at("results", name)


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Write a stage as Parquet and return it read back, so that later steps start from the file."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_final(train: DataFrame, test: DataFrame, paths: Paths, train_name: str = "train_data_final",
                test_name: str = "test_data_final") -> tuple[DataFrame, DataFrame]:
    return write_stage(train, paths.final(train_name)), write_stage(test, paths.final(test_name))


def write_predictions(scored: DataFrame, path: str, row_id: str = "SK_ID_CURR", score: str = "score") -> None:
    """``SK_ID_CURR, TARGET`` as CSV with a header."""
    (scored.select(F.col(row_id).alias("SK_ID_CURR"), F.col(score).cast("double").alias("TARGET"))
     .write.mode("overwrite").option("header", True).csv(path))


def write_names(spark: SparkSession, names: list[str], path: str) -> None:
    """A list of column names, in order."""
    spark.createDataFrame(list(enumerate(names)), "place int, name string").coalesce(1).write.mode("overwrite").parquet(path)


def read_names(spark: SparkSession, path: str) -> list[str]:
    return [r["name"] for r in spark.read.parquet(path).orderBy("place").collect()]
