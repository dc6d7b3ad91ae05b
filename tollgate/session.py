"""Session settings and the scratch folder shared by driver and executors."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_WIDTH = "spark.sql.shuffle.partitions"
_OWN_WIDTH = "tollgate.shuffle.width"
_ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_local_roots: dict[str, str] = {}


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def tune(spark: SparkSession, *inputs: str) -> SparkSession:
    """Apply the settings every job relies on; what the user has set stays.

    Event times are compared in UTC. Adaptive execution splits skewed join partitions
    and merges small ones, so the shuffle only has to be wide enough: as many partitions
    as there are cores, and as the ``inputs``, folders that a job reads, have pieces of
    the advised size. The keys a stream has to remember are kept on disk, not in
    executor memory.
    """
    chosen = spark.conf.getAll
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        _STATE_STORE: _ROCKS,
    }
    for key, value in wanted.items():
        if key not in chosen:
            spark.conf.set(key, value)
    if chosen.get(_WIDTH) == chosen.get(_OWN_WIDTH):  # none yet, or the one set here before
        width = max(spark.sparkContext.defaultParallelism, _pieces(spark, inputs), int(chosen.get(_OWN_WIDTH, 1)))
        for key in (_WIDTH, _OWN_WIDTH):
            spark.conf.set(key, str(width))
    return spark


def _pieces(spark: SparkSession, inputs: Sequence[str]) -> int:
    """How many partitions of the advised size the files under ``inputs`` fill."""
    jvm, size = spark._jvm, 0
    for name in inputs:
        path = jvm.org.apache.hadoop.fs.Path(name)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        size += system.getContentSummary(path).getLength() if system.exists(path) else 0
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get(_ADVISED, "64m").lower()).groups()
    return -(-size // (int(number) << 10 * " kmgt".index(unit or " ")))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(scan: DataFrame) -> DataFrame:
    """A scan with work for every core.

    A table of many files stays as it is. One of fewer files than there are cores, such
    as one compressed file, is dealt out evenly before work that costs more than moving
    its rows.
    """
    width = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(width) if len(scan.inputFiles()) < width else scan


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the cluster's shared checkpoint folder.

    Only a local session without that setting gets a temporary folder of its
    own: on a cluster the executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        root = _local_roots.setdefault(app, tempfile.mkdtemp(prefix="tollgate-"))
    return f"{root.rstrip('/')}/tollgate/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and not
    again when an executor is lost."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
