"""Outputs of several files published together, by versioned folders and one record.

A version is written to a folder of its own. It becomes current when the record ``<name>.current.json`` is replaced in
one rename, so readers see all files of one version or all of another, and a write that
dies leaves the earlier version as it was. One writer at a time a name.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import SparkSession

#: Versions that stay readable: the current one and one before, for readers that have just looked.
KEEP_VERSIONS = 2


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _record_path(folder: str, name: str) -> str:
    return os.path.join(folder, f"{name}.current.json")


def current_version(spark: SparkSession, folder: str, name: str) -> dict | None:
    """The record of the current version, its files as whole paths; None if nothing has been published."""
    jvm, path, fs = _hadoop(spark, _record_path(folder, name))
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    record = json.loads(text)
    record["files"] = {k: os.path.join(folder, v) for k, v in record["files"].items()}
    return record


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file beside ``path`` and puts it in its place in one rename."""
    jvm, target, fs = _hadoop(spark, path)
    _, beside, _ = _hadoop(spark, f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    out = fs.create(beside)
    try:
        out.write(bytearray(text.encode("utf-8")))
        out.hsync()
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(beside), fs.makeQualified(target), options)


def publish(spark: SparkSession, folder: str, name: str, writers: dict[str, Callable[[str], None]], files: dict[str, str]) -> dict[str, str]:
    """Runs each writer with a path of the new version, then makes that version current; returns the paths.

    ``files`` are the file names by writer. If a writer fails nothing changes for readers.
    """
    version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    root = f"{name}.versions"
    before = current_version(spark, folder, name)
    paths = {k: os.path.join(folder, root, version, f) for k, f in files.items()}
    for k, write in writers.items():
        write(paths[k])
    kept = ([version] + (before["versions"] if before else []))[:KEEP_VERSIONS]
    record = {"version": version, "files": {k: os.path.join(root, version, f) for k, f in files.items()}, "versions": kept}
    _replace(spark, _record_path(folder, name), json.dumps(record))
    _drop_older(spark, os.path.join(folder, root), kept)
    return paths


def _drop_older(spark: SparkSession, root: str, kept: list[str]) -> None:
    """Removes versions older than those kept, among them what writes that died have left."""
    _, path, fs = _hadoop(spark, root)
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name not in kept and name < min(kept):
            fs.delete(status.getPath(), True)
