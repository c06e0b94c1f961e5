"""Files and folders of any store that Spark's file systems reach: small texts, settings beside tables, free space."""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, SparkSession


class SubmissionError(ValueError):
    """An output breaks a hard rule."""


def located(spark: SparkSession, path: str):
    """(file system, path) in the JVM."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark: SparkSession, path: str) -> bool:
    system, p = located(spark, path)
    return system.exists(p)


def is_file(spark: SparkSession, path: str) -> bool:
    system, p = located(spark, path)
    return system.exists(p) and system.getFileStatus(p).isFile()


def size(spark: SparkSession, path: str) -> int:
    system, p = located(spark, path)
    return system.getContentSummary(p).getLength()


def read_bytes(spark: SparkSession, path: str, start: int = 0, n: int | None = None) -> bytes:
    """Bytes of a small file, or ``n`` of a large one."""
    system, p = located(spark, path)
    stream = system.open(p)
    try:
        stream.seek(start)
        n = system.getFileStatus(p).getLen() - start if n is None else min(n, system.getFileStatus(p).getLen() - start)
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, max(0, n)))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, p = located(spark, path)
    out = system.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename over what may be there."""
    system, a = located(spark, source)
    _, b = located(spark, target)
    system.delete(b, True)
    if not system.rename(a, b):
        raise OSError(f"{source} could not become {target}")


def remove(spark: SparkSession, path: str) -> None:
    system, p = located(spark, path)
    system.delete(p, True)


def joined(spark: SparkSession, folder: str, target: str, head: str = "") -> None:
    """The part files of a folder as one file, byte by byte, in the order of their names."""
    system, p = located(spark, folder)
    parts = sorted((s.getPath() for s in system.listStatus(p) if s.getPath().getName().startswith("part-")), key=lambda x: x.getName())
    home, out_path = located(spark, target)
    out = home.create(out_path, True)
    try:
        out.write(bytearray(head.encode()))
        for part in parts:
            stream = system.open(part)
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
            finally:
                stream.close()
    finally:
        out.close()


def plain(value):
    """A value that JSON can hold: NaN and infinities are null."""
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, list | tuple):
        return [plain(v) for v in value]
    return None if isinstance(value, float) and not math.isfinite(value) else value


def write_json(spark: SparkSession, path: str, value) -> None:
    write_text(spark, path, json.dumps(plain(value), indent=1, sort_keys=True))


def read_json(spark: SparkSession, path: str):
    return json.loads(read_bytes(spark, path))


def ready(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet folder was written to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def pin(spark: SparkSession, folder: str, settings: dict) -> None:
    """Leave the settings in a folder; what is there was made with the same ones, or it is an error."""
    settings, place = plain(settings), f"{folder}/_settings.json"
    if not exists(spark, place):
        write_json(spark, place, settings)
    elif (old := read_json(spark, place)) != settings:
        other = sorted(k for k in {*old, *settings} if old.get(k) != settings.get(k))
        raise SubmissionError(f"{folder} was made with other settings: " + ", ".join(f"{k} was {old.get(k)!r}, is {settings.get(k)!r}" for k in other))


def materialise(frame: DataFrame, path: str, overwrite: bool = False, settings: dict | None = None) -> DataFrame:
    """Write once: a finished folder is read, an unfinished one written anew.

    A finished folder that was made with other ``settings``, or with unknown ones, is refused.
    """
    spark = frame.sparkSession
    if overwrite or not ready(spark, path):
        check_disk(spark, path)
        frame.write.mode("overwrite").option("compression", "zstd").parquet(path)
        if settings is not None:
            write_json(spark, f"{path}/_settings.json", settings)
    elif settings is not None:
        if not exists(spark, f"{path}/_settings.json"):
            raise SubmissionError(f"{path} does not say how it was made")
        pin(spark, path, settings)
    return spark.read.schema(frame.schema).parquet(path)


def check_disk(spark: SparkSession, path: str, least_gb: float = 3.0) -> float:
    """Free space of the store that holds ``path``; an error if it is under ``least_gb``."""
    system, _ = located(spark, path)
    free = system.getStatus().getRemaining() / 1e9
    if free < least_gb:
        raise OSError(f"{free:.1f} GB free of {least_gb} needed for {path}")
    return free
