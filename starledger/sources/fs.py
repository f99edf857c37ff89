"""Small file-system operations through the Hadoop FileSystem API of the
session, so the same code works on local disk, HDFS and object stores.

Only control-plane metadata (manifests, pointer files, listings) goes through
here; data always moves through DataFrame readers and writers.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _jpath(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _jpath(spark, path)
    return bool(fs.exists(p))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _jpath(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str, recursive: bool = True) -> None:
    fs, p = _jpath(spark, path)
    if fs.exists(p):
        fs.delete(p, recursive)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    fs, p = _jpath(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def file_info(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, length, modification time) of every file under ``path``."""
    fs, p = _jpath(spark, path)
    if not fs.exists(p):
        return []
    it = fs.listFiles(p, True)
    out = []
    while it.hasNext():
        st = it.next()
        out.append((st.getPath().toString(), int(st.getLen()), int(st.getModificationTime())))
    return sorted(out)


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    write_bytes(spark, path, text.encode("utf-8"), overwrite)


def write_bytes(spark: SparkSession, path: str, data: bytes, overwrite: bool = True) -> None:
    fs, p = _jpath(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole: written under a hidden name, then renamed, so
    no reader sees half of it.  False when ``path`` exists already."""
    import uuid

    fs, p = _jpath(spark, path)
    if fs.exists(p):
        return False
    folder, name = path.rsplit("/", 1)
    hidden = f"{folder}/_{name}.{uuid.uuid4().hex}"
    write_text(spark, hidden, text)
    if fs.rename(_jpath(spark, hidden)[1], p):
        return True
    delete(spark, hidden)
    return False


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _jpath(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Files under a file, folder or glob, without hidden ones and markers."""
    hadoop, p = _jpath(spark, path)
    found = hadoop.globStatus(p)
    names = []
    for st in found or []:
        if st.isDirectory():
            names += [name for name, _, _ in file_info(spark, st.getPath().toString())]
        else:
            names.append(st.getPath().toString())
    return sorted(n for n in names if not n.rsplit("/", 1)[-1].startswith(("_", ".")))


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file that isn't blank (decompressed by its
    name's ending); None when there is none."""
    hadoop, p = _jpath(spark, path)
    jvm = spark.sparkContext._jvm
    stream = hadoop.open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
            spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
        raw = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(raw, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return line
    finally:
        stream.close()
