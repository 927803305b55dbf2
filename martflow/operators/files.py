"""Folder questions asked of whatever file system a path lives on."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _open(spark, path)
    return fs.exists(handle)


#: File systems where a file that must not exist yet is created by one answer of their server.
EXCLUSIVE_SCHEMES = ("hdfs", "webhdfs", "swebhdfs", "abfs", "abfss", "gs", "ofs", "o3fs")
#: What others (object stores) must say they can do, and are then told to do.
CONDITIONAL_CREATE = "fs.option.create.conditional.overwrite"


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path``, in one step with all its text; False if there is one already.

    Of any number of writers exactly one gets True. On a local disk a finished
    file is linked to the name, which fails if the name is taken; elsewhere the
    server decides. A file system that cannot decide is refused: renames that
    merge or overwrite, and looking first, let two writers win.
    """
    fs, handle = _open(spark, path)
    fs.mkdirs(handle.getParent())
    scheme = fs.getUri().getScheme()
    if scheme == "viewfs":
        # A view decides nothing itself.
        return create(spark, f"{fs.resolvePath(handle.getParent()).toString()}/{handle.getName()}", text)
    if scheme == "file":
        return _link(spark, fs, handle, text)
    builder = fs.createFile(handle).overwrite(False)
    if fs.hasPathCapability(handle, CONDITIONAL_CREATE):
        builder = builder.must(CONDITIONAL_CREATE, True)
    elif scheme not in EXCLUSIVE_SCHEMES:
        raise ValueError(f"{scheme} cannot create a file for one writer only, so versions cannot be published in {path}")
    try:
        out = builder.build()
        out.write(bytearray(text.encode()))
        out.close()
    except Exception as refused:
        # Not another writer but some other trouble: say so.
        if not fs.exists(handle):
            raise refused
        return False
    return True


def _link(spark: SparkSession, fs, handle, text: str) -> bool:
    jvm = spark._jvm
    attempt = jvm.org.apache.hadoop.fs.Path(handle.getParent(), f".attempt-{uuid4().hex}")
    named = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (handle, attempt)]
    jvm.java.nio.file.Files.write(named[1], bytearray(text.encode()), spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 0))
    try:
        jvm.java.nio.file.Files.createLink(*named)
        return True
    except Exception as refused:
        if not fs.exists(handle):
            raise refused
        return False
    finally:
        jvm.java.nio.file.Files.delete(named[1])


def read_text(spark: SparkSession, path: str) -> str:
    fs, handle = _open(spark, path)
    size = fs.getFileStatus(handle).getLen()
    stream = fs.open(handle)
    data = spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)
    stream.close()
    return bytes(b & 0xFF for b in data).decode()


def size(spark: SparkSession, path: str) -> int:
    """Stored bytes at or below ``path``; 0 if it does not exist."""
    fs, handle = _open(spark, path)
    return fs.getContentSummary(handle).getLength() if fs.exists(handle) else 0


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    fs, handle = _open(spark, path)
    if not fs.exists(handle):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(handle) if s.isDirectory())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path``."""
    fs, handle = _open(spark, path)
    if not fs.exists(handle):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(handle) if s.isFile())


def changed_at(spark: SparkSession, path: str) -> float:
    """When ``path`` was last changed, in seconds since 1970."""
    fs, handle = _open(spark, path)
    return fs.getFileStatus(handle).getModificationTime() / 1000


def remove(spark: SparkSession, path: str) -> None:
    fs, handle = _open(spark, path)
    fs.delete(handle, True)
