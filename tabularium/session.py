"""Session helpers. Nothing here runs on import; every other module takes its frames or a session as arguments."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Adaptive execution is what sizes and splits shuffle and write partitions at run time;
# master, memory and connector settings belong to the deployment.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str, conf: Mapping[str, str] | None = None, hive: bool = False) -> SparkSession:
    """Get the running session, or build one with adaptive execution on and ``conf`` on top."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def new_session(app_name: str, conf: Mapping[str, str] | None = None) -> SparkSession:
    """A session with its own settings and temporary views on the running application, or a first one.

    ``conf`` and the defaults are set on it; of a running application's settings only those that can
    be changed at run time.
    """
    active = SparkSession.getActiveSession()
    if active is None:
        return build_session(app_name, conf)
    session = active.newSession()
    for name, value in {**DEFAULT_CONF, **(conf or {})}.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or one in the warehouse where that is unset.

    A warehouse on local disks is no shared folder once there are executors on other machines: each would write
    to its own disk and rows would be lost without an error, so this raises there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    local = not re.match(r"(?!file:)[A-Za-z][A-Za-z0-9+.-]+:", warehouse)
    if local and not re.match(r"local(\[|$)", spark.conf.get("spark.master", "local")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share; the warehouse is a local folder")
    return f"{warehouse.rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below :func:`shared_folder`."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of scratch data."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
