"""Where intermediate tables go: a folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from siltstone.sources import folders

_FOLDER = "siltstone"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A session without that setting uses a folder in its warehouse, which every
    executor has to reach as well. No machine-local folder is ever used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path no other call returns, under the shared folder.

    It has the application's id in it, so that ``remove_scratch`` finds it.
    """
    return f"{shared_folder(spark)}/{_FOLDER}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, application: str | None = None) -> bool:
    """Delete the scratch tables of an application, by default this one's.

    Frames that read them fail afterwards. Returns whether there were any.
    """
    path = f"{shared_folder(spark)}/{_FOLDER}/{application or spark.sparkContext.applicationId}"
    found = folders.exists(spark, path)
    if found:
        folders.delete(spark, path)
    return found
