"""What the operators of this subpackage share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.session import ship_package

#: Words as the contracts define them: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_tasks(spark: SparkSession, rows: int = 500, megabytes: int = 16) -> None:
    """What Python on the executors needs: this package, and a bound on what one Arrow
    batch holds (texts may be long, a worker's memory is not)."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one after it that no column has."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


def text_or_empty(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


#: Rows of a few fixed-size columns that may be broadcast.
MOST_BROADCAST = 2_000_000


def small_side(written: DataFrame) -> DataFrame:
    """A written table of keys as the side of a join: broadcast if its rows, counted, are
    few; otherwise the join shuffles."""
    return F.broadcast(written) if written.count() <= MOST_BROADCAST else written
