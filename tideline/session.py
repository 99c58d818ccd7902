"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every tideline job relies on. AQE re-plans joins and coalesces
# shuffle partitions at runtime; the session zone pins window alignment and
# timestamp casts to UTC so batch, stream and the DuckDB oracle agree.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Streaming session windows merge the sessions of a map partition before the shuffle.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    # transformWithState needs the RocksDB state store.
    **(ROCKSDB := {"spark.sql.streaming.stateStore.providerClass":
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}),
}


def build_session(master: str | None = None, app_name: str = "tideline",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with tideline's defaults.

    On a cluster leave ``master`` as None so spark-submit decides; tests pass
    ``local[N]``. ``shuffle_partitions`` should track total cores for small
    inputs; for large inputs leave it unset and let AQE coalesce.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and streaming state.

    Read from ``spark.checkpoint.dir`` as the cluster configures it. A folder
    of this machine would be seen by nobody else, so one is chosen in local
    mode only; elsewhere an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir is not set; {master} needs a folder that driver and executors share")
        import tempfile
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="tideline-checkpoints-")
        root = _LOCAL_ROOTS[app]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def checkpoint_location(spark: SparkSession, job: str) -> str:
    """The checkpoint folder of a streaming job: the same for every start of ``job``, so that it resumes."""
    if not re.fullmatch(r"[\w.-]+", job):
        raise ValueError(f"a job's name holds letters, digits, _, . and - only: {job!r}")
    return f"{checkpoint_root(spark).rstrip('/')}/jobs/{job}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, with the writer's ``options``, and read back: its lineage ends there, its size is known."""
    path = shared_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def _pickle_worker_code_by_value() -> None:
    """Serialize the classes that run in Python workers together with their code.

    ``transformWithState`` also unpickles the processor in a driver-side
    Python runner that does not see ``addPyFile`` paths; by-value pickling
    makes the processors and the UDTF self-contained.
    """
    import importlib

    from pyspark import cloudpickle
    for name in ("tideline.functions.udtf", "tideline.streaming.state", "tideline.streaming.signals",
                 "tideline.streaming.dedup", "tideline.streaming.changelog"):
        cloudpickle.register_pickle_by_value(importlib.import_module(name))


def ship_package(spark: SparkSession) -> None:
    """Make ``tideline`` importable in Python workers (UDTFs, stateful processors).

    Zips the package once per application and registers it with
    ``addPyFile``, so executors get it on their ``sys.path`` wherever the
    driver was started from (the same as ``--py-files`` at submit time).
    Worker-side classes are also pickled by value (see above).
    """
    _pickle_worker_code_by_value()
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import tempfile
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="tideline-pyfiles-"), f"tideline-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    p = os.path.join(d, f)
                    z.write(p, os.path.relpath(p, root))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)


_MIB = 1 << 20


def scale_conf(input_bytes: int, total_cores: int, scan_split_bytes: int = 512 * _MIB,
               shuffle_partition_bytes: int = 256 * _MIB) -> dict[str, str]:
    """Scan and shuffle sizing for a job reading ``input_bytes`` on ``total_cores``.

    * scans split at ``scan_split_bytes`` (fewer, larger map tasks: at 100 TB
      and 512 MiB that is about 200k tasks, not 800k);
    * the first shuffle starts at one partition per ``shuffle_partition_bytes``
      of input and at least two waves of cores; AQE then coalesces toward the
      advisory size and splits skewed join partitions.
    """
    parts = max(2 * total_cores, -(-input_bytes // shuffle_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * shuffle_partition_bytes),
    }
