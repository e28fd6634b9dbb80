"""Small file-system calls through Hadoop, so any scheme Spark can read works here too."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Matching paths in name order; none for a pattern that matches nothing."""
    found = _fs(spark, pattern).globStatus(_path(spark, pattern)) or []
    return sorted(status.getPath().toString() for status in found)


def name_of(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def head(spark: SparkSession, path: str, size: int) -> bytes:
    """At most the first `size` bytes of a file, unpacked if its name tells a codec, as Spark's readers do."""
    stream = _fs(spark, path).open(_path(spark, path))
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(_path(spark, path))
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file; readers see the old or the new content."""
    fs = _fs(spark, path)
    fresh = f"{path}.new"
    stream = fs.create(_path(spark, fresh), True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, path).toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(_path(spark, fresh), _path(spark, path), options)
