"""Stages of a fitted pipeline that keep a table: it is saved beside their parameters and read again where they are loaded."""

from __future__ import annotations

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if (table := self.instance.table()) is not None:
            table.write.parquet(f"{path}/table")


class _Reader(DefaultParamsReader):
    def load(self, path: str):
        stage = super().load(path)
        if stage.getOrDefault(stage.source):
            stage._set(source=f"{path}/table")
        return stage


class TableStage(MLReadable, MLWritable):
    """Mixin of a transformer with a table at ``source``; an empty source means that there is none."""

    source = Param(Params._dummy(), "source", "folder of the table", TypeConverters.toString)

    def table(self) -> DataFrame | None:
        path = self.getOrDefault(self.source)
        if not path:
            return None
        # A thread that a search started has no active session of its own.
        return (SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()).read.parquet(path)

    def write(self) -> _Writer:
        return _Writer(self)

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)
