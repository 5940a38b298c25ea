"""Session construction and the shared stage folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every duelframe job relies on.  AQE re-plans joins from runtime
# sizes (so small derived tables are broadcast only when they really are
# small) and splits skewed shuffle partitions; UTC keeps dates stable.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # one-pass profiles aggregate hundreds of columns at once; the default
    # (100 fields) would drop those plans out of whole-stage codegen
    "spark.sql.codegen.maxFields": "1000",
    # HotSpot never compiles a method of more than 8,000 bytes of bytecode;
    # above that (a hundred columns in one projection) plans are faster split
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app: str = "duelframe",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with duelframe's defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_defaults(spark)
    return spark


# Spark's own defaults for the keys above; on a session we did not build,
# only keys still at these values are changed, so a cluster's explicit
# settings always win.
SPARK_BUILTIN = {"spark.sql.codegen.maxFields": "100", "spark.sql.codegen.hugeMethodLimit": "65535"}


def apply_defaults(spark: SparkSession) -> None:
    """Raise settings still at Spark's built-in value on an existing session.

    AQE, skew-join handling and ANSI mode are Spark 4 defaults already and
    are left as the session has them.
    """
    for k, builtin in SPARK_BUILTIN.items():
        try:
            if spark.conf.get(k, builtin) == builtin:
                spark.conf.set(k, SESSION_DEFAULTS[k])
        except Exception:  # static or locked conf: keep the cluster's value
            pass


#: Key, Spark's own default, and the value for jobs whose rows grow wide after narrow scans and shuffles.
SMALLER_TASKS = [("spark.sql.files.maxPartitionBytes", "134217728b", "32m"),
                 ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "67108864b", "16m")]


@contextmanager
def smaller_tasks(spark: SparkSession) -> Iterator[None]:
    """Tasks take a quarter of the bytes meanwhile, and hold a quarter of the rows; a cluster's own values stay."""
    changed = [(k, builtin, value) for k, builtin, value in SMALLER_TASKS if spark.conf.get(k, builtin) == builtin]
    try:
        for k, _, value in changed:
            spark.conf.set(k, value)
        yield
    finally:
        for k, _, _ in changed:
            spark.conf.unset(k)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for lineage cuts, if any."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or None


def ensure_checkpoint_dir(spark: SparkSession, folder: str | None = None) -> str:
    """Use ``folder`` or the configured checkpoint folder.

    Only a local master, whose executors share the driver's machine, may go
    without: it then gets a fresh folder of its own (tests, local benches).
    """
    d = folder or checkpoint_dir(spark)
    if not d:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="duelframe-ckpt-")
    if d != checkpoint_dir(spark):
        spark.sparkContext.setCheckpointDir(d)  # the conf key itself is static
    return d
