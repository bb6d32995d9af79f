"""Tables written on the way, in the cluster's shared checkpoint folder.

A stage table ends a lineage (an expensive weight or token count is computed once), and it survives
the loss of executors. Each ``Stage`` owns one folder of its own and removes it on ``close``.

A driver that is killed closes nothing. So a folder holds a lease, which its owner renews for as long as it lives, and
the first ``Stage`` of a session removes the folders beside its own whose lease has run out. Times are those of the file
system, which writes both leases, so clocks need not agree.
"""

import tempfile
import threading
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from sluice.sources.tables import delete_path, folder_names, modified, planned_splits, write_small

CHECKPOINT_DIR = "spark.checkpoint.dir"
FEW_SPLITS = 16
FOLDER, LEASE = "stage-", "_lease"
#: How long a folder outlives its owner's last sign of life, and how often the owner gives one.
LEASE_SECONDS, RENEW_SECONDS = 6 * 3600, 600

_open: "set[Stage]" = set()
_swept: set[tuple[str, str]] = set()
_lock = threading.Lock()
_renewer: threading.Thread | None = None


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by the cluster; a temporary one only in local mode."""
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    root = tempfile.mkdtemp(prefix="sluice-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir()


@dataclass(frozen=True)
class Staged:
    """A stage table read back, its number of rows, and what else was measured on writing it."""

    rows: DataFrame
    count: int
    figures: dict


def plain(schema: T.StructType) -> T.StructType:
    """The schema with every column nullable, as files give it back."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


class Stage:
    """A run's own folder of stage tables; use as a context manager, or call ``close``."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        root = root or checkpoint_root(spark)
        self.path = f"{root}/{FOLDER}{uuid.uuid4().hex}"
        self.renew()
        with _lock:
            _open.add(self)
            first = (spark.sparkContext.applicationId, root) not in _swept
            _swept.add((spark.sparkContext.applicationId, root))
        _keep_renewing()
        if first:
            sweep(spark, root, self.path)

    def renew(self) -> None:
        """Give a sign of life."""
        write_small(self.spark, f"{self.path}/{LEASE}", str(time.time()))

    def write(
        self,
        rows: DataFrame,
        name: str,
        measures: Sequence[Column] = (),
        file_rows: int = 0,
        narrow: bool = False,
        parts: int = 0,
    ) -> "Staged":
        """Write ``rows``; their number and the ``measures`` are collected by the same pass.

        They are counted in the writing stage itself, where Spark applies each task's update once.
        ``file_rows`` bounds the rows of a file; 0 leaves it to the tasks. ``narrow`` rows are much smaller
        than what they are read from: unless that is small, they are rebalanced, or each of many scan tasks
        would leave a tiny file. ``parts`` bounds the tasks that write; 0 leaves it to the shuffle.
        """
        seen, path = Observation(), f"{self.path}/{name}"
        if narrow and planned_splits(rows) > FEW_SPLITS:
            rows = rows.hint("rebalance")
        if parts:
            rows = rows.coalesce(parts)
        observed = rows.observe(seen, F.count("*").alias("rows"), *measures)
        observed.write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(path)
        figures = seen.get
        return Staged(self.read(plain(rows.schema), name), figures["rows"], figures)

    def read(self, schema: T.StructType, *names: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{n}" for n in names])

    def close(self) -> None:
        with _lock:  # a lease renewed now would bring the folder back
            _open.discard(self)
            delete_path(self.spark, self.path)

    def __enter__(self) -> "Stage":
        return self

    def __exit__(self, *_) -> None:
        self.close()


def sweep(spark: SparkSession, root: str, own: str) -> list[str]:
    """Remove the stage folders beside ``own`` whose lease has run out by the time that ``own`` was leased; their names.

    A folder without a lease is left alone: its owner may be about to write one.
    """
    now, gone = modified(spark, f"{own}/{LEASE}"), []
    for name in folder_names(spark, root):
        leased = modified(spark, f"{root}/{name}/{LEASE}") if name.startswith(FOLDER) else None
        if leased is not None and now is not None and now - leased > LEASE_SECONDS * 1000:
            delete_path(spark, f"{root}/{name}")
            gone.append(name)
    return gone


def renew_all() -> None:
    """Renew the leases of all open folders of this process whose session lives."""
    with _lock:
        for stage in list(_open):
            if stage.spark.sparkContext._jsc is None:
                _open.discard(stage)
            else:
                stage.renew()


def _keep_renewing() -> None:
    global _renewer

    def work() -> None:
        while True:
            time.sleep(RENEW_SECONDS)
            renew_all()

    with _lock:
        if _renewer is None:
            _renewer = threading.Thread(target=work, name="stage leases", daemon=True)
            _renewer.start()
