"""Helpers common to the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"\x20\x09-\x0D"
#: A word, as a Java pattern that never backtracks.
WORD = rf"[^{SPACE}]++"


def shared_dir(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`, which driver and executors share.

    Only a local master may go without that setting: it gets a temporary folder of its own (tests).
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = _LOCAL.setdefault(spark.sparkContext.applicationId, None) or tempfile.mkdtemp(prefix="dockyard-llm-")
    _LOCAL[spark.sparkContext.applicationId] = own
    return own


_LOCAL: dict[str, str | None] = {}


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet in the shared folder and read again: computed once, and safe from lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once per row, also where `body` uses it within a lambda."""
    return F.transform(F.array(value), body)[0]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame) -> DataFrame:
    """One struct column `row` with all columns of `df`, so that names made here cannot clash with its own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, like: DataFrame, *more: str) -> DataFrame:
    """The columns of `like` out of `row`, with further columns after them; a further column replaces its namesake."""
    own = [F.col("row")[c].alias(c) for c in like.columns if c.lower() not in {m.lower() for m in more}]
    return df.select(*own, *more)


def sliced(batches: Iterator, rows: int = 128) -> Iterator:
    """Arrow batches (arrays, or tuples of them) in slices of few rows, so that few texts are Python objects at once.

    Spark bounds the batches themselves by spark.sql.execution.arrow.maxBytesPerBatch (64 MB unless set); no setting
    of the caller's session is changed.
    """
    for batch in batches:
        parts = batch if isinstance(batch, tuple) else (batch,)
        for i in range(0, len(parts[0]), rows):
            some = tuple(p.slice(i, rows) for p in parts)
            yield some if isinstance(batch, tuple) else some[0]


def discard(*tables: DataFrame) -> None:
    """Removes tables of `stored` that nothing reads any more: what came of them has been written too."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
