"""Written intermediate tables, Arrow batch sizes and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almacen.sources.workspace import shared_folder

#: Rows and bytes that cross to a Python worker at once; texts may be long.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20
#: A side of a join is broadcast when its counted rows take no more than this.
BROADCAST_BYTES = 16 << 20


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Let Spark's file server hand this package to the executors' Python workers."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="almacen-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as code:
        for file in sorted(package.rglob("*.py")):
            code.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def prepared(spark: SparkSession) -> SparkSession:
    """Ship this package to Python workers and bound the batches sent to them."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows below the shared folder and read them back.

    Later jobs read the files: nothing is computed twice, the lineage ends here
    and a lost executor takes nothing with it.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` wrote and that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def bounded(df: DataFrame, *texts: str) -> DataFrame:
    """Marked for broadcast if its rows, with the real lengths of these text columns, take little enough."""
    lengths = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in texts), F.lit(16 * len(df.columns)))
    size = df.agg(F.sum(lengths.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def small_or_not(df: DataFrame, row_bytes: int) -> DataFrame:
    """Marked for broadcast if its counted rows are few enough, else as it is."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df
