"""Spark session helpers.

Library code never creates a session: operators use the session of the
DataFrames they are given.  These helpers are for tests, the benchmark and
command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "cohortguard") -> SparkSession:
    """A local session configured the way the library expects.

    * AQE on, with partition coalescing and skew-join splitting, so shuffle
      sizes adapt at run time.
    * Session time zone UTC, so ISO timestamps in hash payloads are stable.
    * Arrow on, for the few ``mapInPandas``/``applyInPandas`` operators.
    * No UI server.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("COHORTGUARD_DRIVER_MEMORY", "16g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="cg-wh-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cohortguard`` importable in the executors' Python workers.

    Folds, per-site fits and streaming state functions run in Python
    workers, which import this package.  Like ``spark-submit --py-files``,
    the package is zipped once on the driver and registered with
    ``addPyFile``, which copies it to every executor.  Once per SparkContext.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="cg-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "cohortguard"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir=os.path.basename(pkg_dir))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant
    folder and is used as is.  Where it is unset, a local session (tests) gets
    a fresh scratch folder; any other raises, since executors would not share
    a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cg-ckpt-"))
    return sc.getCheckpointDir()
