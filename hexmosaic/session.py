"""Session defaults and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "12g", folder: str | None = None) -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own.

    Intermediate tables go to ``folder``; without it to what the installation sets, else to a temporary
    folder of the application.
    """
    own = {"spark.checkpoint.dir": folder} if folder else {}
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hexmosaic")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config(map=own)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Temporary folders of local applications that set none, by application.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's checkpoint folder, read from the session.

    Only a local session that sets none gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        folder = _LOCAL[app] = _LOCAL.get(app) or tempfile.mkdtemp(prefix="hexmosaic-")
    return folder.rstrip("/")


def new_path(spark: SparkSession, kind: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Loops use this between rounds: the plan stays short, and a lost executor costs a re-read of
    files instead of a recomputation of all rounds. The known table size also lets Spark pick the
    join strategy of the next round.
    """
    spark = df.sparkSession
    path = new_path(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unsent(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that Spark sorts and never broadcasts.

    For sides that grow with the input: their files, or the rows before an explode, can be a hundred
    times smaller than what a broadcast would hold in the driver's memory.
    """
    return df.hint("merge")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out to all tasks of a shuffle, whatever its files.

    For rows that stand for far more work than their bytes say: a small file is a single task, and so
    would be everything up to the next shuffle. The fixed number keeps Spark from merging the parts.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def dealt(by: list[str], counted: DataFrame, rows: int, *tables: DataFrame) -> list[DataFrame]:
    """``tables`` partitioned by the columns ``by``, with at least a partition for every ``rows`` rows of ``counted``.

    For tasks that keep what they read in memory: with the session's number of partitions, or the
    splits of a file, a task grows with the input. Up to ``rows`` rows the tables are left as they
    are. ``counted`` should be a table or a filter of one, as it is counted at once.
    """
    count = counted.count()
    if count <= rows:
        return list(tables)
    parts = max(-(-count // rows), int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return [t.repartition(parts, *by) for t in tables]


class Rounds:
    """Lineage cuts of a loop, in two tables that take turns, so storage does not grow with rounds.

    ``cut`` writes a table and reads it back; the table written two calls before is overwritten, so
    only the last two results may still be in use.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.turn = spark, new_path(spark, "rounds"), 0

    def cut(self, df: DataFrame) -> DataFrame:
        path, self.turn = f"{self.base}-{self.turn % 2}", self.turn + 1
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def bind(df: DataFrame, keep: list[str], **exprs: Column) -> DataFrame:
    """Columns ``keep`` plus computed columns that later steps see as plain columns.

    Catalyst substitutes projected expressions into the filters and projections above them, which
    multiplies long arithmetic. A one-element generator ends the substitution, so each expression
    is evaluated once per row and the generated code stays small.
    """
    tmp = df.select(*keep, *[e.alias(f"_{n}") for n, e in exprs.items()])
    fields = [F.col(f"_{n}").alias(n) for n in exprs]
    return tmp.select(*keep, F.inline(F.array(F.struct(*fields))))
