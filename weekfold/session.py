"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from py4j.protocol import Py4JJavaError
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_shared: set[tuple[str, str]] = set()
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit"


def build_session(app: str = "weekfold", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is tuned for.

    Adaptive execution sizes shuffles and splits skewed join partitions; UTC
    keeps period arithmetic independent of the machine.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        # plans here are built from generated columns; recording a Python call
        # site for each of them costs more than planning does
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        _METHOD_BYTES: "8000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def refuse_unshared(path: str, master: str, default_fs: str, vouched: bool) -> None:
    """Raise if executors on other machines could not see ``path``.

    A folder of a plain file system is shared only if somebody mounted it
    everywhere; ``spark.weekfold.sharedFiles=true`` vouches for that, and
    ``shared_dir`` tries it.
    """
    if master.startswith("local") or vouched:
        return
    scheme = path.split(":", 1)[0] if "://" in path or path.startswith("file:") else default_fs.split(":", 1)[0]
    if scheme == "file":
        raise ValueError(
            f"{path} is on each machine's own disk: name a shared folder in spark.checkpoint.dir, or set "
            "spark.weekfold.sharedFiles=true if it is mounted on every machine"
        )


def written_everywhere(spark: SparkSession, path: str) -> bool:
    """Whether rows that tasks on all cores write below ``path`` are there for the driver and for tasks again."""
    tasks = spark.sparkContext.defaultParallelism
    probe = f"{path.rstrip('/')}/probe-{uuid.uuid4().hex[:12]}"
    rows = spark.range(0, tasks, 1, tasks)
    try:
        rows.write.parquet(probe)
        return spark.read.schema(rows.schema).parquet(probe).count() == tasks
    except (Py4JJavaError, CapturedException):
        return False


def _named_folder(spark: SparkSession) -> str | None:
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not named and context.getCheckpointDir():
        named = context.getCheckpointDir().rsplit("/", 1)[0]
    return named


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, from ``spark.checkpoint.dir``, else one in the warehouse.

    A folder on a plain file system may be mounted everywhere or not, so it is
    tried once an application. Where none is named, a folder of our own is set
    if the master is local, which is the case in tests; on a cluster the
    warehouse, where tables are kept anyway, is tried in its place.
    """
    context = spark.sparkContext
    named = _named_folder(spark)
    default_fs = context._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    vouched = spark.conf.get("spark.weekfold.sharedFiles", "false") == "true"
    if not named and context.master.startswith("local"):
        named = tempfile.mkdtemp(prefix="weekfold-")
        context.setCheckpointDir(named)
    elif not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/weekfold-scratch"
    tried = (context.applicationId, named)
    if tried not in _shared:
        try:
            refuse_unshared(named, context.master, default_fs, vouched)
        except ValueError:
            if not written_everywhere(spark, named):
                raise
        _shared.add(tried)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def compile_by_parts(spark: SparkSession) -> None:
    """Let Spark split the code of very wide projections, unless the application says otherwise.

    The JVM never compiles a method of more than 8,000 bytes; Spark's own limit,
    beyond which it splits the code of a stage by operator and expression, is 65,535.
    """
    if not spark.sparkContext.getConf().contains(_METHOD_BYTES):
        spark.conf.set(_METHOD_BYTES, "8000")


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application, and keep their batches small.

    Spark distributes the archive itself, so executors need no installation.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    if not context.getConf().contains(_ARROW_BYTES):
        # a worker holds a batch several times over: as text, as words, as results
        spark.conf.set(_ARROW_BYTES, "8m")
    home = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="weekfold-"), "weekfold.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(home)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back.

    Used where several consumers or an iterative fit would otherwise recompute
    a long plan; the written table survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
