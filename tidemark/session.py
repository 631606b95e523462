"""Spark session settings and lineage cuts.

Everything in the package takes a ``SparkSession`` from the caller; this
module only supplies the settings the engine relies on (UTC, AQE) and the
checkpoint directory used to cut lineage.  Dynamic partition overwrite is
set on the landing writer only, so a "replace" elsewhere stays a replace.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Settings every job assumes.  Time is UTC so that Unix seconds and
# timestamps convert the same way on every executor.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for scripts and tests.  On a cluster the launcher passes the
    master and sizing; here we only add the engine settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    # Checkpoint files of collected DataFrames are removed with them.
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_engine_conf(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Runtime SQL settings the operators depend on (idempotent)."""
    for k, v in ENGINE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: keep theirs
            pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A session without that setting (the tests and the bench make their own)
    gets a fresh folder beside its tables, in ``spark.sql.warehouse.dir``,
    which all executors of a session share.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tidemark-scratch"
    sc.setCheckpointDir(shared)
    return sc.getCheckpointDir() or shared


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` to the checkpoint folder (reliable
    checkpoint, never a local one).  Partitioning and ordering of the plan are
    kept, so later operators can reuse them."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _sql_literal(v) -> str:
    """Python value -> Spark SQL literal text (strings escaped)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return f"{v}L" if abs(v) >= 2 ** 31 else str(v)
    if isinstance(v, float):
        return f"{v!r}D"
    if isinstance(v, (list, tuple)):
        return "array(" + ", ".join(_sql_literal(x) for x in v) + ")"
    text = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def literal_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small constant table (control rows, parameters) from one SQL
    ``VALUES`` text: it plans as a local scan, with no Python worker (unlike
    ``createDataFrame`` on a list) and one parse instead of a call per
    literal."""
    from pyspark.sql.types import StructType

    st = StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], st)
    aliases = [f"c{i}" for i in range(len(st.fields))]
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    casts = ", ".join(f"CAST({a} AS {f.dataType.simpleString()}) AS `{f.name}`" for a, f in zip(aliases, st.fields))
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({', '.join(aliases)})")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint folder (shared on a cluster) for
    intermediate tables, landing files and stream checkpoints."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex[:12]}"
