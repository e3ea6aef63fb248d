"""Session helpers: the settings the operators expect, and shipping the package.

On a cluster the session already exists; :func:`tune` only fills settings that
are unset.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a sort-merge join turns into a broadcast only for a measured (runtime) size
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def _default_driver_memory() -> str:
    """At most 8g, and at most 60% of the machine's memory (local mode runs in the driver JVM)."""
    try:
        total_mb = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") // (1024 * 1024)
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1024, min(8192, int(total_mb * 0.6)))}m"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cardwatch") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CARDWATCH_DRIVER_MEMORY", _default_driver_memory()))
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Fill in the defaults above where the session leaves them unset."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cardwatch`` importable in the Python workers of every executor.

    Functions run by ``mapInArrow`` are pickled by reference to their module,
    so the executors need the package.  When it was not submitted with
    ``--py-files``, it is zipped once per application (read only by the
    driver) and handed to ``SparkContext.addPyFile``, which serves it to every
    executor with the job.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    submitted = spark.conf.get("spark.submit.pyFiles", "") or ""
    if "cardwatch" in submitted:
        # shipped at submit time (``--py-files cardwatch.zip``), as on a cluster
        _SHIPPED.add(sc.applicationId)
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="cardwatch-pkg-"), "cardwatch.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
