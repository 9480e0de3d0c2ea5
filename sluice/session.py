"""Session settings, registration of the sources, shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Runtime settings the engine's results depend on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

_local_folders: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply `SETTINGS` and make the sources usable from `spark`."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    _register_sources(spark)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the one named by `spark.checkpoint.dir`.

    Without that setting a local session gets a temporary folder; a cluster
    session is refused, because its executors do not share local disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="sluice-")
        base = _local_folders[app]
    return f"{base.rstrip('/')}/sluice/{app}/{name}-{uuid.uuid4().hex}"


def _register_sources(spark: SparkSession) -> None:
    import sluice
    from sluice.sources.rest_pages import RestPages
    from sluice.sources.rows import FixedPosts, RawRecords

    # Sources travel to the workers as code: files added to the context do not reach
    # the process that plans a stream.
    cloudpickle.register_pickle_by_value(sluice)
    # Spark looks for sources of the same name in the active session.
    spark._jvm.SparkSession.setActiveSession(spark._jsparkSession)
    for source in (RestPages, RawRecords, FixedPosts):
        spark.dataSource.register(source)
