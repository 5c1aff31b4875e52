"""Session helpers: reading test tables, and cutting lineage safely on a cluster."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``sf_dir``; a file or a folder of files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Makes ``checkpoint()`` usable.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. A folder of our own is set only for a
    plain ``local`` master without that setting, as in tests; on a cluster a machine-local folder would be lost with
    its machine, so the setting is demanded instead.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="kgspark-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def _storable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return bool(kind.fields) and all(_storable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _storable(kind.elementType)
    if isinstance(kind, T.MapType):
        return _storable(kind.keyType) and _storable(kind.valueType)
    return isinstance(kind, T.StringType | T.BinaryType | T.BooleanType | T.NumericType | T.DateType | T.TimestampType | T.TimestampNTZType)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared checkpoint folder, with its lineage cut.

    It is written as a table, which is smaller than a checkpoint of rows, lets later steps read only the columns they
    use, and tells the planner its size. Its files go when the application ends. Columns are stored by number, so their
    names may be any; types that a table can't hold are checkpointed as rows.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not df.columns or not _storable(df.schema):
        return df.checkpoint(eager=True)
    sc = spark.sparkContext
    path = f"{sc.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    stored = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    stored.write.parquet(path)
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(stored.schema).parquet(path).toDF(*df.columns)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application.

    Workers import what a function needs by name; they need not share the driver's path or folder.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():  # else the package is itself read from an archive that was sent
        archive = Path(tempfile.mkdtemp(prefix="kgspark-")) / "kgspark.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)
