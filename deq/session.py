"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Split a hot key even where the split costs one more shuffle.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # JSON texts may repeat a name; the last one counts.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


#: Folders of local sessions that name none, by application.
_LOCAL: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors share, as named by spark.checkpoint.dir.

    Only a local session may fall back on a folder of this machine, one for all its steps.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        # A running session takes no new value for this setting, so the choice is kept here.
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        root = _LOCAL[app]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nobody used before."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def literal_rows(spark: SparkSession, rows: list[tuple], fields: str) -> DataFrame:
    """A few rows written into the plan itself; no job has to ship them."""
    schema = T.StructType.fromDDL(fields)
    cells = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)]) for row in rows
    ]
    if not cells:
        return spark.createDataFrame([], schema)
    return spark.range(1).select(F.inline(F.array(*cells)))


def materialize(df: DataFrame) -> DataFrame:
    """Write a result to the shared folder and read it back.

    Cuts the lineage, so that later steps see one fixed result and a lost executor costs no
    recomputation; as a Parquet table it is compressed, pruned by column and known by size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
