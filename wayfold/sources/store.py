"""Files through Hadoop's file systems, from the driver: the shared folder of a run, listing, small texts, atomic publishing. Paths are local ones or those of any store that Spark reads."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def session() -> SparkSession:
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("no active Spark session")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names. Only where it is unset and all is one machine, as in tests, a folder of its own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at
    if spark.sparkContext.getCheckpointDir() is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(os.path.join(tempfile.gettempdir(), "wayfold-checkpoints"))
    return spark.sparkContext.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/wayfold-{name}-{uuid.uuid4().hex}"
    fs, at = _fs(path)
    fs.deleteOnExit(at)
    return path


def _fs(path: str) -> tuple:
    spark = session()
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(path: str) -> bool:
    fs, at = _fs(path)
    return fs.exists(at)


def size(path: str) -> int | None:
    """Bytes of a file; None if there is none."""
    fs, at = _fs(path)
    return fs.getFileStatus(at).getLen() if fs.exists(at) else None


def delete(path: str) -> None:
    fs, at = _fs(path)
    fs.delete(at, True)


def names(folder: str, prefix: str = "", suffix: str = "") -> list[str]:
    """Names of the files in a folder that begin and end so, sorted; none if there is no folder."""
    fs, at = _fs(folder)
    if not fs.exists(at):
        return []
    found = (s.getPath().getName() for s in fs.listStatus(at) if s.isFile())
    return sorted(n for n in found if n.startswith(prefix) and n.endswith(suffix) and not n.endswith(".crc"))


def read_text(path: str) -> str:
    """A small UTF-8 file."""
    fs, at = _fs(path)
    stream = fs.open(at)
    try:
        return bytes(session()._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(path: str, text: str) -> None:
    """A small UTF-8 file, written beside its place and renamed, so that no reader sees half of it."""
    part = f"{path}.part"
    fs, at = _fs(part)
    stream = fs.create(at, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    replace(part, path)


def replace(source: str, target: str) -> None:
    """Renames over what may be there, in one step where the store can."""
    jvm, gateway = session()._jvm, session().sparkContext._gateway
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    fs, at = _fs(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), session()._jsc.hadoopConfiguration())
    context.rename(_fs(source)[1], at, options)


def fetch(source: str, local: str) -> None:
    """A copy on the driver's disk, for packaging."""
    fs, at = _fs(source)
    fs.copyToLocalFile(False, at, session()._jvm.org.apache.hadoop.fs.Path(f"file://{os.path.abspath(local)}"), True)


def publish(source: str, target: str) -> None:
    """Copy beside the target, check the size, rename. An empty file is not published."""
    wanted = size(source)
    if not wanted:
        raise OSError(f"{source} is empty or missing")
    from_fs, from_at = _fs(source)
    part = f"{target}.part"
    to_fs, to_at = _fs(part)
    to_fs.mkdirs(to_at.getParent())
    copied = session()._jvm.org.apache.hadoop.fs.FileUtil.copy(from_fs, from_at, to_fs, to_at, False, True, session()._jsc.hadoopConfiguration())
    if not copied or size(part) != wanted:
        delete(part)
        raise OSError(f"copy of {source} is not complete")
    replace(part, target)
