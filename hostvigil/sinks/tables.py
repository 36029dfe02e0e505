"""Landed tables and alert results on any Hadoop file system."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write many parts under ``path``, replacing what is there; CSV gets headers."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def _paths(spark: SparkSession, *names: str):
    jvm = spark._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(name) for name in names]
    return paths[0].getFileSystem(spark._jsc.hadoopConfiguration()), paths


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write many parts and put them in the place of ``path`` once all are written.

    A job that fails leaves the old table as it was, and the new one never mixes with it. Between
    two renames there is no table for a moment; one that is in the way of the second rename is
    put back if that fails.
    """
    spark = df.sparkSession
    made, old = (f"{path.rstrip('/')}_{uuid.uuid4().hex}" for _ in range(2))
    try:
        write_table(df, made, fmt)
    except Exception:
        drop_table(spark, made)
        raise
    fs, (source, target, aside) = _paths(spark, made, path, old)
    if fs.exists(target) and not fs.getFileStatus(target).isDirectory():
        drop_table(spark, made)
        raise FileExistsError(f"{path} is a file")
    replaced = fs.exists(target) and fs.rename(target, aside)
    if not fs.rename(source, target):
        if replaced:
            fs.rename(aside, target)
        raise OSError(f"could not rename {made} to {path}")
    if replaced:
        fs.delete(aside, True)


def publish_single_csv(df: DataFrame, path: str) -> bool:
    """Write ``df`` as the one CSV file ``path``; False if no file came out.

    One task writes everything, so this is for callers who ask for one file. An older file is
    replaced only once the new one lies beside it; a folder of that name is an error.
    """
    spark = df.sparkSession
    folder = f"{path}_{uuid.uuid4().hex}"
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(folder)
    fs, (source, target) = _paths(spark, folder, path)
    parts = [
        status.getPath()
        for status in fs.listStatus(source)
        if status.getPath().getName().startswith("part-")
    ]
    if not parts:
        fs.delete(source, True)
        return False
    if fs.exists(target) and fs.getFileStatus(target).isDirectory():
        fs.delete(source, True)
        raise FileExistsError(f"{path} is a folder")
    old = _paths(spark, f"{folder}/old")[1][0]
    replaced = fs.exists(target) and fs.rename(target, old)
    done = fs.rename(parts[0], target)
    if replaced and not done:
        fs.rename(old, target)
    fs.delete(source, True)
    return done


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder and those above it, if they are missing."""
    fs, (folder,) = _paths(spark, path)
    fs.mkdirs(folder)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a folder written by this run."""
    fs, (folder,) = _paths(spark, path)
    fs.delete(folder, True)
