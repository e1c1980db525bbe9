"""Folders of the file system behind a path."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = _resolve(spark, path)
    return system.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``, sorted; [] if there is no such folder."""
    system, hadoop_path = _resolve(spark, path)
    if not system.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(hadoop_path))


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    system, hadoop_path = _resolve(spark, path)
    stream = system.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with all its content at once; False if it exists already.

    Of several writers of one path exactly one succeeds: the text is written beside the
    path and moved there by a rename (on a local disk: a link) that never replaces.
    """
    system, target = _resolve(spark, path)
    system.mkdirs(target.getParent())
    beside = spark._jvm.org.apache.hadoop.fs.Path(
        target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}"
    )
    stream = system.create(beside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if system.getScheme() == "file":
            os.link(beside.toUri().getPath(), system.makeQualified(target).toUri().getPath())
        else:
            hadoop = spark._jvm.org.apache.hadoop.fs
            never = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
            never[0] = hadoop.Options.Rename.NONE
            context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
            context.rename(system.makeQualified(beside), system.makeQualified(target), never)
        return True
    except Exception:  # one file system reports it in one way, another in another
        if not system.exists(target):
            raise
        return False
    finally:
        system.delete(beside, False)


def data_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files directly under ``path``, sorted."""
    return [name for name in child_names(spark, path) if not name.startswith(("_", "."))]


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all that is under a folder."""
    system, hadoop_path = _resolve(spark, path)
    return system.getContentSummary(hadoop_path).getLength()


def move_into(spark: SparkSession, path: str, name: str, folder: str) -> None:
    """Move the file ``name`` from ``path`` to ``folder``, where no file has its name."""
    system, source = _resolve(spark, f"{path}/{name}")
    if not system.rename(source, _resolve(spark, f"{folder}/{name}")[1]):
        raise OSError(f"{name} was not moved to {folder}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, or a file."""
    system, hadoop_path = _resolve(spark, path)
    system.delete(hadoop_path, True)
