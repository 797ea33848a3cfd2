"""Results that later steps use again and again, kept in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def settled(df: DataFrame) -> DataFrame:
    """df checkpointed: its plan ends here, and a lost executor costs nothing. Where no folder is set, a local session takes one of
    its own; on a cluster that is an error, since executors would write to disks that nobody else reads."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        base = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not base and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(base or tempfile.mkdtemp(prefix="cutweave-"))
    return df.checkpoint()


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """df dealt to all tasks by a hash of these columns: for steps that take long for each row, since a file that is read may be one task."""
    session = df.sparkSession
    return df.repartition(max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism), *columns)
