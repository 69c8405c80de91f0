"""Session helpers: a local session for tests/bench and a shared scratch
folder taken from ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench.  A cluster job gets its
    session from the launcher and never calls this."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusforge")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Pages are large rows: keep Arrow batches to the extraction job small.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to a shared file system; only when it
    is unset (local tests) do we pick a folder of our own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="corpusforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
        pass
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder (never a
    machine-local temp dir on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def local_rows(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A few rows that the driver has (one per source, label or column) as a
    local relation: no job makes them, and Spark knows their size."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = list(zip(*rows, strict=True)) or [[] for _ in struct]
    return spark.createDataFrame(pa.table([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow), struct)


def spread(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over all task slots when it has fewer partitions
    than slots (a small file with few row groups feeding CPU-heavy text or
    parsing work).  A large input already has more splits than slots and is
    returned unchanged: no shuffle at scale."""
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: leave as is
        return df
    return df.repartition(slots) if parts < slots else df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file system that Spark itself uses
    for the path, with or without a scheme."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
