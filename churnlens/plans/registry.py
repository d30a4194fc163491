"""A registry of trained sets (K3, K4): models, features, spec and state of the data under one version.

A version is written beside the others and published by one rename, so a reader
sees all of it or nothing.  Loading needs no more than the folder: the manifest
names segments and features, and a table that lacks a feature is refused.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from churnlens.api import TrainedModels
from churnlens.config import DEFAULT_SPEC, ChurnSpec


@dataclasses.dataclass(frozen=True)
class Version:
    number: int
    trained: TrainedModels
    spec: ChurnSpec
    data_state: str | None


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    p, fs = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())


def _spec_dict(spec: ChurnSpec) -> dict:
    return {f.name: getattr(spec, f.name) for f in dataclasses.fields(spec) if f.name != "extra"}


def _spec_from(held: dict) -> ChurnSpec:
    def back(name, value):
        if name in ("first_period", "second_period"):
            return tuple(dt.datetime.fromisoformat(v) for v in value)
        if name == "lifetime_end":
            return dt.datetime.fromisoformat(value)
        return tuple(tuple(v) if isinstance(v, list) else v for v in value) if isinstance(value, list) else value
    return ChurnSpec(**{k: back(k, v) for k, v in held.items()})


def publish(spark: SparkSession, root: str, trained: TrainedModels, spec: ChurnSpec = DEFAULT_SPEC, data_state: str | None = None) -> int:
    """Store a trained set as the next version; its number."""
    root = root.rstrip("/")
    incoming = f"{root}/.incoming-{uuid.uuid4().hex}"
    trained.save(incoming)
    manifest = {"segments": list(trained.models), "features": list(trained.features), "spec": _spec_dict(spec), "data_state": data_state}
    p, fs = _fs(spark, f"{incoming}/manifest.json")
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(manifest, default=lambda x: x.isoformat()).encode()))
    finally:
        out.close()
    number = max(versions(spark, root), default=0) + 1
    while True:
        target, fs = _fs(spark, f"{root}/v{number:06d}")
        # a rename onto a folder that is there would move into it
        if not fs.exists(target) and fs.rename(_fs(spark, incoming)[0], target):
            return number
        number += 1


def load(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """A published version, by default the latest."""
    root = root.rstrip("/")
    if number is None:
        held = versions(spark, root)
        if not held:
            raise FileNotFoundError(f"no version is published in {root}")
        number = held[-1]
    folder = f"{root}/v{number:06d}"
    manifest = json.loads("\n".join(r[0] for r in spark.read.text(f"{folder}/manifest.json", wholetext=True).collect()))  # one small file
    models = {s: PipelineModel.load(f"{folder}/model_{s}") for s in manifest["segments"]}
    trained = TrainedModels(PipelineModel.load(f"{folder}/segments"), models, manifest["features"])
    return Version(number, trained, _spec_from(manifest["spec"]), manifest["data_state"])


def check_features(version: Version, table: DataFrame) -> DataFrame:
    """``table``, if it has every feature of the version."""
    missing = [f for f in version.trained.features if f not in table.columns]
    if missing:
        raise ValueError(f"version {version.number} needs columns that the table lacks: {', '.join(missing)}")
    return table
