"""Small files and folders on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _open(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, sorted; nothing if there is none."""
    place, system = _open(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(place)) if system.exists(place) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there whole or not at all."""
    place, system = _open(spark, path)
    draft, _ = _open(spark, f"{path}.draft")
    out = system.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    system.delete(place, False)
    if not system.rename(draft, place):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    place, system = _open(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    place, system = _open(spark, path)
    system.delete(place, True)
