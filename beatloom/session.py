"""Session settings the operators rely on. A cluster's own settings always win."""

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 2_000_000

def object_store_conf(
    endpoint: str, access_key: str | None = None, secret_key: str | None = None
) -> dict[str, str]:
    """Spark settings for an S3-compatible store; pass them to `build_session(conf=...)`.

    Without keys the store's own credential chain is used; timeouts are left to Hadoop.
    """
    s3a = {
        "endpoint": endpoint,
        # Buckets of such stores are seldom host names of their own.
        "path.style.access": "true",
        "connection.ssl.enabled": str(not endpoint.startswith("http:")).lower(),
    }
    if access_key and secret_key:
        s3a |= {"access.key": access_key, "secret.key": secret_key}
    return {f"spark.hadoop.fs.s3a.{name}": value for name, value in s3a.items()}


def build_session(
    app_name: str = "beatloom", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared checkpoint folder the session names (`spark.checkpoint.dir`).

    Only a local session without one gets a temporary folder; a cluster has to name its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="beatloom-"))


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; a larger side keeps a shuffled join, whose heavy keys
    Spark splits at run time. For narrow rows (an id and a number) that are cheap to count."""
    return F.broadcast(df) if df.count() <= max_rows else df
