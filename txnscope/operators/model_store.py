"""A versioned folder of a fitted model's parts.

Each part (features, isolation forest, random forest, clusters, bank graph) is a set of
Parquet tables, MLlib models and one-row values under its own name. A part counts once
its ``done`` marker is written, after everything else, so a job that stopped half-way
leaves nothing that is read; it is then fitted and written again. All access goes
through Spark, so the folder may be in any store the cluster shares.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

FORMAT = 1


class ModelStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def at(self, part: str, name: str) -> str:
        return f"{self.path}/{part}/{name}"

    def has(self, part: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.at(part, "done") + "/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def finish(self, part: str) -> None:
        """Mark the part as complete; the last write of a part."""
        self.write_values(part, "done", {"format": FORMAT})

    def check(self, part: str) -> None:
        if not self.has(part):
            raise FileNotFoundError(f"the model at {self.path} has no complete part {part!r}")
        found = self.values(part, "done")["format"]
        if found != FORMAT:
            raise ValueError(f"the model at {self.path} has format {found}, not {FORMAT}")

    # --- tables ---
    def write_table(self, part: str, name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self.at(part, name))

    def table(self, part: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.at(part, name))

    # --- small values (numbers, names) as one row of JSON ---
    def write_values(self, part: str, name: str, values: dict) -> None:
        one = self.spark.createDataFrame([(json.dumps(values),)], "value STRING").coalesce(1)
        one.write.mode("overwrite").text(self.at(part, name))

    def values(self, part: str, name: str) -> dict:
        return json.loads(self.spark.read.text(self.at(part, name)).first()[0])

    # --- MLlib models ---
    def write_ml(self, part: str, name: str, model) -> None:
        model.write().overwrite().save(self.at(part, name))

    def ml(self, part: str, name: str, kind):
        return kind.load(self.at(part, name))
