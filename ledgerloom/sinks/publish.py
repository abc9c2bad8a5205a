"""Output that appears as a whole: a run writes a folder of its own, and one small manifest names the run in force.

A job that dies leaves the manifest as it was, so readers that follow it see the run before, or none. Earlier runs stay
for readers that have them open.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import SparkSession

MANIFEST = "manifest.json"


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.hadoop.fs


def _delete(spark: SparkSession, path: str) -> None:
    folder = _hadoop(spark).Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _name_run(spark: SparkSession, out: str, manifest: Mapping[str, Any]) -> None:
    """Writes the manifest beside its place and puts it there in one rename over the one before."""
    fs, configuration = _hadoop(spark), spark.sparkContext._jsc.hadoopConfiguration()
    target = fs.Path(f"{out}/{MANIFEST}")
    draft = fs.Path(f"{out}/runs/{manifest['run']}/{MANIFEST}")
    system = target.getFileSystem(configuration)
    stream = system.create(draft, True)
    stream.write(bytearray(json.dumps(manifest).encode()))
    stream.close()
    overwrite = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    overwrite[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(system.getUri(), configuration).rename(
        system.makeQualified(draft), system.makeQualified(target), overwrite
    )


def publish(spark: SparkSession, out: str, write: Callable[[str], Mapping[str, Any]]) -> Mapping[str, Any]:
    """Calls ``write`` with the folder of a new run and publishes it with the facts that ``write`` returns.

    If ``write`` raises, the run's folder is removed and nothing is published. If the process dies, the folder stays
    behind, but no manifest names it.
    """
    out = out.rstrip("/")
    run = uuid.uuid4().hex
    folder = f"{out}/runs/{run}"
    try:
        facts = write(folder)
    except BaseException:
        _delete(spark, folder)
        raise
    manifest = {**facts, "run": run}
    _name_run(spark, out, manifest)
    return manifest


def published(spark: SparkSession, out: str) -> tuple[str, dict[str, Any]]:
    """Folder and manifest of the run in force. ``FileNotFoundError`` if none was ever published."""
    path = _hadoop(spark).Path(f"{out.rstrip('/')}/{MANIFEST}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        raise FileNotFoundError(f"no run is published below {out}")
    manifest = json.loads(spark.read.text(path.toString(), wholetext=True).first()[0])
    return f"{out.rstrip('/')}/runs/{manifest['run']}", manifest
