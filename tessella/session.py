"""Sessions, lineage cuts and size checks shared by the operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(name: str = "tessella", cpus: str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and trials; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests) without one gets a folder of its own, one a session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    session = spark.sparkContext.applicationId
    if session not in _OWN:
        _OWN[session] = tempfile.mkdtemp(prefix="tessella-")
    return _OWN[session]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def inline_table(spark: SparkSession, rows, names: list[str]) -> DataFrame:
    """A small constant table as a local relation, whose size the planner knows."""
    quote = lambda v: "'" + v.replace("'", "\\'") + "'" if isinstance(v, str) else "NULL" if v is None else repr(v)
    values = ", ".join("(" + ", ".join(quote(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    Filters over ordinary computed columns are pushed below them with every use
    spelled out again; a one-row ``inline`` keeps long expressions in one place.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))
