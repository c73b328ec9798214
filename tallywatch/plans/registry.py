"""Model versions and the champion alias, kept as small versioned tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallywatch.operators.upsert import upsert_into
from tallywatch.sources.tables import VersionedTable

CHAMPION = "champion"
_VERSIONS_DDL = "model STRING, version INT, algorithm STRING, test_pr_auc DOUBLE, path STRING, inputs STRING"
_ALIASES_DDL = "model STRING, alias STRING, version INT"


@dataclass(frozen=True)
class Registry:
    spark: SparkSession
    root: str
    model: str = "fraud_model"

    @property
    def _versions(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/versions", _VERSIONS_DDL, "model")

    @property
    def _aliases(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/aliases", _ALIASES_DDL, "model")

    def register(
        self, fitted: PipelineModel, algorithm: str, test_pr_auc: float, inputs: list[str]
    ) -> int:
        """Save a model with the columns it was fitted on as the next version; every version is kept."""
        version = (self._versions.read().select(F.max("version")).first()[0] or 0) + 1
        path = f"{self.root}/models/version={version}"
        fitted.write().overwrite().save(path)
        row = self.spark.createDataFrame(
            [(self.model, version, algorithm, test_pr_auc, path, ",".join(inputs))], _VERSIONS_DDL
        )
        upsert_into(self._versions, row, ["model", "version"])
        return version

    def point(self, version: int, alias: str = CHAMPION) -> None:
        """Move an alias: promotion and rollback are this one step."""
        known = self._versions.read().where(F.col("version") == version)
        if known.isEmpty():
            raise ValueError(f"no version {version} of {self.model}")
        row = self.spark.createDataFrame([(self.model, alias, version)], _ALIASES_DDL)
        upsert_into(self._aliases, row, ["model", "alias"])

    def resolve(self, alias: str = CHAMPION) -> int | None:
        row = self._aliases.read().where(F.col("alias") == alias).select("version").first()
        return None if row is None else row["version"]

    def load(self, version: int, inputs: list[str]) -> PipelineModel:
        """A stored model; fails if it was fitted on other columns, or in another order, than ``inputs``."""
        row = self._versions.read().where(F.col("version") == version).select("inputs").first()
        if row is None:
            raise ValueError(f"no version {version} of {self.model}")
        if row["inputs"] != ",".join(inputs):
            raise ValueError(f"version {version} was fitted on {row['inputs']}, not on {','.join(inputs)}")
        return PipelineModel.load(f"{self.root}/models/version={version}")
