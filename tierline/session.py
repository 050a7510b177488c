"""Session settings and the shared folder intermediate tables go to."""

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on.

    A JSON object with a repeated key keeps the last value, as JSONB does;
    without the setting such a payload would be compared as plain text.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="tierline-")
    return _local_dirs[sc.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh, unused path in the shared folder, dropped when the session ends."""
    path = f"{shared_dir(spark)}/tierline/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package as a zip file in the shared folder, once a session:
    their Python workers need not have it installed or on their path."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(root.rglob("*.py")):
            z.writestr(str(source.relative_to(root.parent)), source.read_bytes())
    path = f"{new_folder(spark, 'package')}/{root.name}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def stage(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    For inputs that several jobs read (a fetched batch): it is computed once, and
    a lost executor costs a re-read of the table, not of the source.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
