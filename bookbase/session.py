"""Session defaults and the shared scratch folder."""

import shutil
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app="bookbase", master=None, **conf):
    """A session with the engine's defaults; `conf` keys use `_` for `.`, e.g. spark_driver_memory."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("_", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark):
    """Make this package importable in the Python workers of the session, once per application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).parent
        name = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(name)
        _shipped.add(application)


_local_scratch = None
_shipped = set()
_made = ContextVar("scratch folders of the innermost scope", default=None)


def scratch_path(spark, name):
    """A new folder name under the shared folder named by `spark.checkpoint.dir`.

    Only a local-mode session may go without that setting: it gets a temporary folder,
    which every task of a local session can see.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        _local_scratch = _local_scratch or tempfile.mkdtemp(prefix="bookbase-")
        base = _local_scratch
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark):
    """Delete the scratch folders made inside the block when it ends.

    For jobs that repeat, such as micro-batches: nothing may read a result lazily afterwards. Scopes
    that overlap in different threads keep their folders apart.
    """
    made = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def materialise(df: DataFrame, name="step", file_rows=0) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Used where a result is read several times and costs too much to derive again; the
    files outlive lost executors, unlike cached blocks. For rows of megabytes, `file_rows` is the most
    of them in a file: Parquet holds a hundred rows before it looks at their size, and up to 4,096 when read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(spark, make, name="step") -> DataFrame:
    """What `make()` gives, written and read back; the scratch folders made on the way are deleted.

    For small results of steps with large scratch tables: nothing else that `make` builds may be read later.
    """
    path = scratch_path(spark, name)
    with scratch_scope(spark):
        made = make()
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def has_data(spark, path):
    """True when the folder `path` holds files other than markers, whether or not a writer marked it done."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(jvm_path):
        return False
    return any(not f.getPath().getName().startswith(("_", ".")) for f in system.listStatus(jvm_path))


def half_written(spark, path):
    """True when a writer left its unfinished files in the folder `path`."""
    return path_exists(spark, f"{path}/_temporary")


def publish(df: DataFrame, path):
    """Write `df` beside `path` and move it there whole, so that `path` never holds part of it."""
    spark = df.sparkSession
    side = f"{path.rstrip('/')}.building-{uuid.uuid4().hex}"
    df.write.parquet(side)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    target = hadoop(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(target) and not has_data(spark, path):
        system.delete(target, True)
    if system.exists(target) or not system.rename(hadoop(side), target):
        raise FileExistsError(f"{path} was made meanwhile; the new table is at {side}")


def spread_few_files(df: DataFrame, key) -> DataFrame:
    """Deal the rows of a small scan over all cores.

    For row-wise work on a handful of small files: only a scan of fewer partitions than there are
    cores is dealt out, and Spark makes a partition of every few megabytes, so a scan that
    is dealt out is small.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def path_exists(spark, path):
    """True when `path` exists on whatever file system it names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def shuffle_partitions(spark):
    """The number of shuffle partitions the session is set to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
