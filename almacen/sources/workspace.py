"""Where intermediate tables are written.

Tables that several jobs read are written out instead of cached: a written
table survives the loss of executors and cuts the lineage.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local session gets a temporary folder that is removed
    when the process ends; on a cluster that is an error.
    """
    configured = spark.conf.get(_SETTING, None)
    application = spark.sparkContext.applicationId
    if configured:
        return f"{configured.rstrip('/')}/almacen/{application}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    if application not in _local_folders:
        _local_folders[application] = tempfile.TemporaryDirectory(prefix="almacen-")
    return _local_folders[application].name
