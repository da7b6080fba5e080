"""Session defaults and the shared scratch folder."""

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


# HotSpot does not compile methods over 8,000 bytes. Wide projections (the 15 factor structs) would
# run interpreted as one generated method; above this limit Spark splits them instead: 3x faster.
HUGE_METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def local_session(cores="8", memory="8g", app="riskloom"):
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores != "*" else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config(*HUGE_METHOD_LIMIT)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_path(spark, name):
    """A fresh path under the folder the cluster shares (``spark.checkpoint.dir``).

    Only on one machine, where tasks and driver see the same disk, a temporary folder does when
    the session names none; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="riskloom-")
    return f"{root.rstrip('/')}/riskloom/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark, path):
    """Delete a table under a scratch path that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def ship_package(spark, folder):
    """Send the package to the executors once per session, for functions that run in tasks."""
    context = spark.sparkContext
    if getattr(context, "_riskloom_shipped", False):
        return
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="riskloom-"), "riskloom"), "zip",
        os.path.dirname(folder), os.path.basename(folder))
    context.addPyFile(archive)
    context._riskloom_shipped = True
