"""Where intermediate tables, stream checkpoints and sinks may be written."""

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path under the session's shared checkpoint folder.

    A local session without one (a unit test) gets a temporary folder. On a cluster the
    folder must be set, since executors do not share the driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="creaseline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/creaseline/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of notes beside a table, written by the driver without a job."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).create(jpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The notes, or None if there are none."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return None
    source = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def literal_path(path: str) -> str:
    """The path for a reader, which takes some characters as a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def path_of_uri(spark: SparkSession, uri: str) -> str:
    """The plain path of a file as Spark's metadata name it."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def delete_path(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def replace_path(spark: SparkSession, staged: str, target: str, aside: str | None = None) -> None:
    """Put a fully written table in the place of another one. The old one goes beside it, or into the folder `aside`, before it is deleted.

    Two renames, so a failure in between leaves both copies on disk. On object stores a
    rename is a copy; publish to a new path there and switch the reader instead.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    src, dst = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(target)
    fs = dst.getFileSystem(conf)
    old = jvm.org.apache.hadoop.fs.Path(f"{aside}/replaced-{uuid.uuid4().hex}" if aside else f"{target}.replaced-{uuid.uuid4().hex}")
    had_old = fs.exists(dst)
    if had_old and not fs.rename(dst, old):
        raise OSError(f"cannot move {target} aside")
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        if had_old:
            fs.rename(old, dst)
        raise OSError(f"cannot move {staged} to {target}")
    if had_old:
        fs.delete(old, True)
