"""Small JSON documents (configuration, schemas) on any Hadoop path."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _locate(spark, path)
    return fs.exists(target)


def make_directory(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.mkdirs(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and its content; nothing happens when it is not there."""
    fs, target = _locate(spark, path)
    fs.delete(target, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``."""
    fs, target = _locate(spark, path)
    return fs.getContentSummary(target).getLength()


def read_json(spark: SparkSession, path: str) -> Any:
    """Parse one document. A missing or damaged document raises."""
    fs, target = _locate(spark, path)
    stream = fs.open(target)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def read_json_if_present(spark: SparkSession, path: str) -> Any | None:
    return read_json(spark, path) if exists(spark, path) else None


def write_json(spark: SparkSession, path: str, document: Any) -> None:
    """Replace one document in one step: a reader finds the old one or the new one."""
    fs, _ = _locate(spark, path)
    _, draft = _locate(spark, path + ".draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(document).encode("utf-8")))
    finally:
        stream.close()
    _replace(spark, path + ".draft", path)


def _replace(spark: SparkSession, draft: str, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, target = _locate(spark, path)
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context.rename(hadoop.Path(draft), target, options)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below ``path``; none where there is nothing."""
    fs, target = _locate(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target)] if fs.exists(target) else []


def largest_number(spark: SparkSession, path: str) -> int:
    """The largest of the file names below ``path`` that are numbers, or -1."""
    return max((int(name) for name in names(spark, path) if name.isdigit()), default=-1)
