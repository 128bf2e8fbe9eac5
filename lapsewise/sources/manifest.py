"""Several datasets that appear together, or not at all.

A run writes its outputs to a folder of its own. Last of all one small manifest, which lists the files of every output
with its schema, takes the place of the former manifest of that label by a single rename. Readers go by the
manifest: a run whose driver was lost before the rename is never seen, and the outputs before it stay as they were.
On object stores without rename a manifest is one object, written at once. Folders of replaced runs are
left for readers that began before the switch.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Data files below a folder, marker and hidden files left out; none if there is no such folder."""
    system, target = _file_system(spark, path)
    found, files = [], system.listFiles(target, True) if system.exists(target) else None
    while files is not None and files.hasNext():
        file = files.next().getPath()
        if not file.getName().startswith(("_", ".")):
            found.append(file.toString())
    return sorted(found)


def _place(root: str, label: str) -> str:
    return f"{root}/manifests/{label}.json"


def lookup(spark: SparkSession, root: str, label: str) -> dict | None:
    """The manifest committed under the label, if any."""
    system, target = _file_system(spark, _place(root, label))
    if not system.exists(target):
        return None
    return json.loads(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(system.open(target)).decode())


def read_output(spark: SparkSession, root: str, label: str, name: str) -> DataFrame | None:
    """The committed output, from the files its manifest lists; None where there is none."""
    output = ((lookup(spark, root, label) or {}).get("outputs") or {}).get(name)
    if output is None:
        return None
    schema = StructType.fromJson(output["schema"])
    if not output["files"]:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    return reader.csv(output["files"], header=True) if output["format"] == "csv" else reader.parquet(*output["files"])


class Run:
    """One run's outputs, committed together under a label."""

    def __init__(self, spark: SparkSession, root: str, label: str) -> None:
        self.spark, self.root, self.label = spark, root, label
        self.name = f"{label}-{uuid.uuid4().hex}"
        self.outputs: dict[str, dict] = {}
        self.notes: dict = {}

    def _path(self, name: str) -> str:
        return f"{self.root}/runs/{self.name}/{name}"

    def _listed(self, df: DataFrame, name: str, kind: str) -> None:
        files = data_files(self.spark, self._path(name))
        self.outputs[name] = {"format": kind, "schema": json.loads(df.schema.json()), "files": files}

    def frame(self, df: DataFrame, name: str) -> DataFrame:
        """Write an output as parquet and read it back, computed once."""
        df.write.parquet(self._path(name))
        self._listed(df, name, "parquet")
        return self.spark.read.schema(df.schema).parquet(self._path(name))

    def csv(self, df: DataFrame, name: str) -> None:
        df.write.option("header", True).csv(self._path(name))
        self._listed(df, name, "csv")

    def commit(self) -> dict:
        """Switch the label to this run's outputs."""
        manifest = {"label": self.label, "run": self.name, "outputs": self.outputs, "notes": self.notes}
        system, target = _file_system(self.spark, _place(self.root, self.label))
        new = system.makeQualified(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifests/.{self.name}"))
        out = system.create(new, True)
        out.write(json.dumps(manifest).encode())
        out.close()
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        rename = getattr(hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = hadoop.FileContext.getFileContext(new.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(new, system.makeQualified(target), options)
        return manifest
