"""Models made of small settings, lookup tables and other models, saved as one artefact."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame


class ComposedModel(Model, MLWritable, MLReadable):
    """`state` is saved as JSON, `tables` as Parquet, `models` with their own writers."""

    def __init__(self, state: dict | None = None, tables: dict[str, DataFrame] | None = None, models: dict | None = None):
        super().__init__()
        self.state = state or {}
        self.tables = tables or {}
        self.models = models or {}

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance: ComposedModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        made_of = {
            "state": self.instance.state,
            "tables": sorted(self.instance.tables),
            "models": sorted(self.instance.models),
        }
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"madeOf": made_of})
        for name, table in self.instance.tables.items():
            table.write.parquet(f"{path}/tables/{name}")
        for name, model in self.instance.models.items():
            model.write().save(f"{path}/models/{name}")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ComposedModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        made_of = metadata["madeOf"]
        tables = {name: spark.read.parquet(f"{path}/tables/{name}") for name in made_of["tables"]}
        models = {name: DefaultParamsReader.loadParamsInstance(f"{path}/models/{name}", spark) for name in made_of["models"]}
        model = self.cls(made_of["state"], tables, models)
        model._resetUid(metadata["uid"])
        return model
