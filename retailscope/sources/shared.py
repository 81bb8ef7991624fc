"""Shared storage that outlives an executor: the folder behind checkpoints and stage outputs."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_PARTITION = 250_000


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only for unset local sessions."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not named:
        already = context._jsc.sc().getCheckpointDir()
        named = already.get() if already.isDefined() else None
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="retailscope-")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(named)
    return named.rstrip("/")


_partitions = threading.RLock()
_asking: list[tuple[int, str]] = []  # the rows of the blocks now open, with what the session asked for before the first


@contextmanager
def partitions_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """Shuffle into enough partitions for ``rows`` while the block writes, so that none has to spill.

    Never fewer than the session asks for; adaptive execution merges what turns out small. Blocks may be open side
    by side: the largest counts, and the last one to end sets the session back.
    """
    name = "spark.sql.shuffle.partitions"
    with _partitions:
        own = (rows, _asking[0][1] if _asking else spark.conf.get(name))
        _asking.append(own)
        spark.conf.set(name, str(max(int(own[1]), *(-(-r // ROWS_PER_PARTITION) for r, _ in _asking))))
    try:
        yield
    finally:
        with _partitions:
            _asking.remove(own)
            spark.conf.set(name, str(max(int(own[1]), *(-(-r // ROWS_PER_PARTITION) for r, _ in _asking))) if _asking else own[1])


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage without relying on executor storage, lets later stages prune columns, and gives
    the optimizer measured sizes, so broadcast decisions rest on fact.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/retailscope/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
