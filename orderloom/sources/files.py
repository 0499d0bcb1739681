"""Files and folders that appear whole: created if absent, or put in the place of an older one."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

from orderloom.session import drop_path, file_system


def beside(path: str) -> str:
    """A new name next to a path; Spark's readers pass over names with a dot in front."""
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/.{name}.{uuid.uuid4().hex[:12]}"


def create_whole(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content; False, and no change, where it exists.

    The text is written aside and then given its name in one step that fails if the name is taken: a link on a POSIX
    folder, a rename without overwriting elsewhere (as HDFS has it).
    """
    aside = beside(path)
    files, place = file_system(spark, aside)
    stream = files.create(place, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if files.getUri().getScheme() == "file":
            os.link(_local(aside), _local(path))
        else:
            rename_new(spark, aside, path)
    except FileExistsError:
        return False
    finally:
        drop_path(spark, aside)
    return True


def rename_new(spark: SparkSession, aside: str, path: str) -> None:
    """Rename a file unless its new name is taken; that is a FileExistsError."""
    jvm = spark._jvm
    mode = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    modes = spark.sparkContext._gateway.new_array(mode, 1)
    modes[0] = mode.NONE
    _, place = file_system(spark, path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(file_system(spark, aside)[1], place, modes)
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            raise FileExistsError(path) from e
        raise


def put_in_place(spark: SparkSession, aside: str, path: str) -> None:
    """Put a finished folder in the place of another one, which is kept until the new one is there."""
    files, new = file_system(spark, aside)
    old, parked = file_system(spark, path)[1], beside(path)
    there = files.exists(old)
    if there and not files.rename(old, file_system(spark, parked)[1]):
        raise OSError(f"{path} could not be moved away")
    if not files.rename(new, old):
        if there:
            files.rename(file_system(spark, parked)[1], old)
        raise OSError(f"{aside} could not be moved to {path}")
    if there:
        drop_path(spark, parked)


def _local(path: str) -> str:
    return unquote(urlparse(path).path) if path.startswith("file:") else path
