"""Stage tables: pipeline boundaries written to the shared checkpoint folder.

The reference pipeline hands files from stage to stage (raw -> cleaned ->
features).  Here each boundary is a parquet table under the folder the
cluster names in ``spark.checkpoint.dir``; reading it back cuts the lineage,
so later queries never recompute the joins, and a lost executor only costs
the tasks of the stage being written.  Without a configured folder the
stages stay lazy plans (always correct, recomputed per query); any failure to
write a stage is raised.

A builder writes to a folder of its own and then creates a small pointer file
that names it.  Nothing is renamed or overwritten, so this also holds on
object stores, where a rename copies objects one by one: readers follow the
pointer, which exists only after the table is complete.  The first pointer
wins; a later builder removes its own folder.  A pointer whose writer died
before it wrote the name is empty: it is passed over, and the next builder
uses the pointer with the next number.
"""

from __future__ import annotations

import hashlib
import uuid
from itertools import count

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from duelframe import __version__
from duelframe.session import checkpoint_dir, smaller_tasks

STAGE_FORMAT = 5  # bump when a stage's definition changes
NAMESPACE_KEY = "spark.duelframe.stageNamespace"
POINTER = "_TABLE"


def _code_digest() -> str:
    """Digest of the modules that define stage contents, so a changed
    definition never reuses a table written by older code."""
    from duelframe import config
    from duelframe.functions import exprs, ordering
    from duelframe.sources import fixtures, io, tables
    h = hashlib.sha1()
    for mod in (config, exprs, ordering, fixtures, io, tables):
        with open(mod.__file__, "rb") as f:
            h.update(f.read())
    return h.hexdigest()


def signature(spark: SparkSession, sf_dir: str, tables: list[str]) -> str:
    """Digest of the code and of the input files' names, sizes and times, as
    the Hadoop file system lists them (local or remote)."""
    h = hashlib.sha1(f"{__version__}/{STAGE_FORMAT}/{_code_digest()}".encode())
    for t in tables:
        fs, root = _fs(spark, f"{sf_dir}/{t}.parquet")
        if not fs.exists(root):
            h.update(f"{t}: none".encode())
            continue
        files = fs.listFiles(root, True)
        found = []
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
        h.update("\n".join(sorted(found)).encode())
    return h.hexdigest()[:16]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def delete(spark: SparkSession, path: str) -> None:
    """Remove a table of one's own, if it is there."""
    fs, root = _fs(spark, path)
    fs.delete(root, True)


def _published(spark: SparkSession, path: str) -> str | None:
    """The complete table that the first pointer with a name points to, if there is one."""
    for number in count():
        fs, pointer = _fs(spark, _pointer(path, number))
        if not fs.exists(pointer):
            return None
        stream = fs.open(pointer)
        try:
            name = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        if name:
            return f"{path}/{name}"


def _pointer(path: str, number: int) -> str:
    return f"{path}/{POINTER}" + (f"-{number}" if number else "")


def _publish(spark: SparkSession, df: DataFrame, path: str) -> str:
    """Write a table of its own, then point to it; the published table's path."""
    name = f"data-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(f"{path}/{name}")
    own_fs, own = _fs(spark, f"{path}/{name}")
    for number in count():
        fs, pointer = _fs(spark, _pointer(path, number))
        try:
            stream = fs.create(pointer, False)
        except Py4JJavaError:
            taken = fs.exists(pointer)
            found = _published(spark, path)
            if found or not taken:  # another builder was first, or the folder can't be written
                own_fs.delete(own, True)
            if found:
                return found
            if not taken:
                raise
            continue  # the pointer is empty
        stream.writeBytes(name)
        stream.close()
        return f"{path}/{name}"


def stage(spark: SparkSession, name: str, sf_dir: str, tables: list[str], build) -> DataFrame:
    """Return stage ``name``: read it if written, else build, write, read."""
    root = checkpoint_dir(spark)
    if not root:
        return build()
    # optional run scope inside the shared folder (the bench uses one so it
    # always measures a fresh build)
    ns = spark.conf.get(NAMESPACE_KEY, "") or ""
    scope = f"{ns.strip('/')}/" if ns else ""
    path = f"{root.rstrip('/')}/duelframe-stages/{scope}{name}-{signature(spark, sf_dir, tables)}"
    if not (done := _published(spark, path)):
        with smaller_tasks(spark):
            done = _publish(spark, build(), path)
    return spark.read.parquet(done)
