"""Python functions on executors that may not have this package installed."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED = "_factspark_shipped"


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, once for each Spark context (a few hundred kilobytes, through Spark's own file server)."""
    sc = spark.sparkContext
    if getattr(sc, _SHIPPED, False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    if os.path.isdir(package):  # not so if it runs from an archive, which is on the executors then
        names = sorted(os.path.join(d, f) for d, _, files in os.walk(package) for f in files if f.endswith(".py"))
        digest = hashlib.sha256(b"".join(open(n, "rb").read() for n in names)).hexdigest()[:16]
        path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="factspark-")), f"factspark-{digest}.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for n in names:
                archive.write(n, os.path.relpath(n, root))
        sc.addPyFile(path)
    setattr(sc, _SHIPPED, True)


def shipped(df: DataFrame) -> DataFrame:
    """The same DataFrame; from now on, executors know the functions of this package. For ``df.transform(shipped).mapInArrow(...)``."""
    ship(df.sparkSession)
    return df
