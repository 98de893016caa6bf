"""Helpers shared by the operators: scratch tables in the session's checkpoint folder, and text kernels."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macropanel.session import ensure_checkpoint_dir


_made: ContextVar[list[Scratch] | None] = ContextVar("scratch tables to drop", default=None)


@contextmanager
def dropping_scratch() -> Iterator[None]:
    """At its end the scratch tables of all operators called inside go; what they returned is written by then."""
    made: list[Scratch] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for scratch in made:
            scratch.drop("")


class Scratch:
    """Intermediate tables of one operator call, written as Parquet into ``spark.checkpoint.dir``.

    A table written there cuts the lineage, survives the loss of an executor, and has a known size, so that
    the planner broadcasts it only under its own threshold. ``drop`` removes a table that is no longer read,
    ``keep`` all but those named; what a returned DataFrame still reads stays in the checkpoint folder with the
    session's other checkpoints, unless its caller writes it inside ``dropping_scratch``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.names: set[str] = set()
        if (made := _made.get()) is not None:
            made.append(self)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.names.add(name)
        df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self.load(name, df)

    def load(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.names.discard(name)

    def keep(self, *names: str) -> None:
        for name in self.names - set(names):
            self.drop(name)


def named(column: str) -> Column:
    """The column of this very name, whatever characters it holds."""
    return F.col(f"`{column.replace('`', '``')}`")


def as_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that no name among them can clash with an operator's own."""
    return F.struct(*[named(c) for c in df.columns]).alias("row")


def whole(text: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def text_key(text: str = "text") -> Column:
    """64 bits of the text that tell rows of one doc_id apart (null differs from empty)."""
    return F.xxhash64(F.col(text).cast("string").isNull(), whole(text))


def chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Slices [a, b) of items whose sizes sum to about ``most``; a larger item is a slice of its own."""
    a, held = 0, 0
    for b, n in enumerate(sizes):
        if b > a and held + n > most:
            yield a, b
            a, held = b, 0
        held += n
    if a < len(sizes):
        yield a, len(sizes)
