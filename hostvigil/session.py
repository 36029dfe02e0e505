"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

#: Set where neither the caller nor spark-submit set them.
PREFERRED = {
    "spark.sql.session.timeZone": "UTC",
    # Most aggregations here meet each key a few times at most; a first small map only costs.
    "spark.sql.codegen.aggregate.map.twolevel.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
_EXCLUDED = "spark.sql.adaptive.optimizer.excludedRules"
_EMPTY = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


def build_session(app_name: str, **conf: str) -> SparkSession:
    """A session with the settings every job relies on; sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in PREFERRED.items():
        if key not in conf and not given.contains(key):
            spark.conf.set(key, value)
    # Stages found empty at run time would otherwise be dropped together with their counters.
    excluded = [rule for rule in (spark.conf.get(_EXCLUDED, None) or "").split(",") if rule]
    if _EMPTY not in excluded:
        spark.conf.set(_EXCLUDED, ",".join([*excluded, _EMPTY]))
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name for written intermediates and streaming checkpoints.

    It lies in the shared folder named by ``spark.checkpoint.dir``, or else beside the session's
    warehouse. On a cluster a warehouse on a local disk will not do, as every machine has its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        master = spark.sparkContext.master
        alone = master.startswith("local") and not master.startswith("local-cluster")
        if not alone and urlsplit(warehouse).scheme in ("", "file"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        shared = warehouse.rstrip("/") + "/_scratch"
    return f"{shared.rstrip('/')}/hostvigil/{name}-{uuid.uuid4().hex}"
