"""Checkpoints: lineage is cut in the shared folder that the cluster names, and rounds that are done with are deleted."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def stored(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in the folder of ``spark.checkpoint.dir``.

    Where none is set, a local master gets a folder of its own. On a cluster
    that would be one on each machine, from which nothing could be read back:
    there it is a ``RuntimeError``.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()


def discard(df: DataFrame) -> None:
    """Deletes the files of a checkpoint that nothing will read again."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.getClass().getSimpleName().startswith("LogicalRDD"):
        raise ValueError("not a checkpoint")
    at = plan.rdd().getCheckpointFile()
    if at.isDefined():
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(at.get())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
