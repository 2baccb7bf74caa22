"""Session, shared scratch space and size-checked joins."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only after it was counted and found at or under this many rows and
# bytes (as text).
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def session(app: str = "lumenframe", cores: int | None = None) -> SparkSession:
    """Local session for tests and benchmarks; clusters bring their own."""
    cores = cores or os.cpu_count() or 4
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LUMENFRAME_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Functions that run in Python workers are pickled by module name, and executors need
    not have the package installed.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="lumenframe-package-"), "lumenframe.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(home):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("lumenframe", os.path.relpath(full, home)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> DataFrame:
    """A table ready for work that is heavy per row.

    A small table may be one row group, hence one task.  Only when the scan has fewer
    tasks than there are cores are its rows spread by key; a large table is left alone.
    """
    df = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def few_tasks(df: DataFrame) -> DataFrame:
    """At most a few tasks per core, without a shuffle.

    For work where every task hands on a matrix of partial sums: those should grow with
    the cluster, not with the number of input blocks.
    """
    spark = df.sparkSession
    width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.coalesce(4 * width)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own.
    """
    conf = spark.sparkContext.getConf()
    configured = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="lumenframe-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Survives the loss of executors, and later stages plan against real file sizes.
    """
    path = fresh_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` is small in rows and in bytes; looks at ``max_rows + 1`` rows at most."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).cast("long"))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), size).first()
    return rows <= max_rows and (size or 0) <= BROADCAST_BYTES


def spread(cols: list[Column], salts: int) -> Column:
    """Deterministic salt from row content, so a retried task gives the same rows."""
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    salts: int = 16,
    known_rows: int | None = None,
) -> DataFrame:
    """Join a large table to a reference table whose keys may be hot on the left.

    ``known_rows`` is a bound the caller has already, such as the n of a top-n list;
    without one the reference table is counted.

    A reference table of checked size is broadcast.  A larger one is joined on
    (key, salt): it is replicated ``salts`` times and the left rows of one key are
    spread over as many tasks.  That join is hinted as a merge: the planner knows the
    size of the files only, not of the rows or their copies, and would broadcast them.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    small = known_rows <= max_rows if known_rows is not None else fits_broadcast(right, max_rows)
    if small:
        return left.join(F.broadcast(right), on, how)
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = left.withColumn("_salt", spread([F.col(c) for c in left.columns], salts))
    return salted.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")
