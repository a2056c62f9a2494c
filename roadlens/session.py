"""Session helpers: UTC event time and the shared folder for lineage cuts.

The caller owns the session. These helpers only read settings, and set their
own value where a setting is unset (tests, local runs).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def ensure_utc(spark: SparkSession) -> None:
    """Event time is UTC everywhere; pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


#: Input rows per first partition of a shuffle. Adaptive execution joins small ones.
ROWS_PER_PARTITION = 250_000
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SET: dict[str, int] = {}


def ensure_partitions(spark: SparkSession, rows: int) -> None:
    """Adaptive shuffles start with partitions in proportion to the input, so
    that what one task sorts doesn't grow with it. The caller's own number
    stays; ours only rises."""
    app, now = spark.sparkContext.applicationId, spark.conf.get(INITIAL_PARTITIONS, None)
    if now is not None and int(now) != _SET.get(app):
        return
    wanted = max(-(-rows // ROWS_PER_PARTITION), int(spark.conf.get("spark.sql.shuffle.partitions")), _SET.get(app, 0))
    spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    _SET[app] = wanted


#: Compressed bytes of messages that one task reads, and of a row group. JSON
#: values take about ten times as much where they are held.
SPLIT_BYTES = 16 * 1024 * 1024
MAX_PARTITION_BYTES = "spark.sql.files.maxPartitionBytes"


@contextmanager
def small_splits(spark: SparkSession):
    """File scans planned inside, also a stream's, have splits of at most
    ``SPLIT_BYTES``. A smaller setting of the caller's stays, and it comes back."""
    before = spark.conf.get(MAX_PARTITION_BYTES, None)
    digits, unit = re.fullmatch(r"(\d+)([bkmgt]?)[a-z]*", spark.conf.get(MAX_PARTITION_BYTES).lower()).groups()
    own = int(digits) << {"k": 10, "m": 20, "g": 30, "t": 40}.get(unit, 0)
    spark.conf.set(MAX_PARTITION_BYTES, str(min(SPLIT_BYTES, own)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(MAX_PARTITION_BYTES)
        else:
            spark.conf.set(MAX_PARTITION_BYTES, before)


EXCLUDED_RULES = "spark.sql.adaptive.optimizer.excludedRules"
EMPTY_PARTS = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


@contextmanager
def whole_plans(spark: SparkSession):
    """Adaptive plans run inside keep a part that turns out to yield no rows, and
    with it the metrics observed there. The caller's own setting comes back."""
    before = spark.conf.get(EXCLUDED_RULES, None)
    spark.conf.set(EXCLUDED_RULES, ",".join([*([before] if before else []), EMPTY_PARTS]))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(EXCLUDED_RULES)
        else:
            spark.conf.set(EXCLUDED_RULES, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator to a shared file system. Only
    when it is unset (tests, local runs) do we pick a scratch folder of our own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster"
            )
        root = tempfile.mkdtemp(prefix="roadlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python code may inspect a local folder."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def is_local(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def ensure_dir(path: str) -> None:
    if is_local(path):
        os.makedirs(local_path(path), exist_ok=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``roadlens`` importable in Python workers (mapInPandas,
    applyInPandas, pandas UDFs). Once per application the package is zipped
    and added with ``addPyFile``, which Spark distributes to every executor;
    deployments that already install the package (``--py-files``, a wheel)
    pay only the zip."""
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="roadlens-pkg-")
    zpath = os.path.join(out_dir, "roadlens.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    spark.sparkContext.addPyFile(zpath)
    _SHIPPED.add(app)
