"""Helpers shared by the operators: columns, stored intermediates, span lists."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import checkpoint_dir, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words are runs of anything but the six ASCII white-space characters.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(text, UPPER, LOWER)


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key's text modulo ``modulus``; null for a null key."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(modulus))


def whole(text: Column) -> Column:
    """The text, a null one read as empty."""
    return F.coalesce(text, F.lit(""))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage like a reliable checkpoint, but compressed and columnar;
    lost executors cost nothing that was already written.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """Arrow batches of about ``size`` bytes for the jobs run inside, unless the session sets its own bound.

    Rows that hold a chunk's text or messages would else fill batches of 64 MB,
    several times over in the executor and in its Python worker.
    """
    if spark.conf.get(ARROW_BYTES, None) is not None:
        yield
        return
    spark.conf.set(ARROW_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.unset(ARROW_BYTES)


def small(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of a small table."""
    return materialize(df)


def bounded_share(n_rows: int, bound: int) -> int:
    """Sampling threshold on a 32-bit hash that keeps about ``bound`` of ``n_rows``."""
    return 2**32 if n_rows <= bound else int(2**32 * bound / n_rows)


def hash32(key: Column) -> Column:
    """A well-mixed 32-bit number of the key, independent of its crc32 folds."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(2**32))


def let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def running(values: str, step: str, ahead: bool = False) -> str:
    """SQL for the running total of an array under ``step``, an associative expression of v and {w} (null beyond the ends).

    Each round doubles how far back (or ``ahead``) an element has looked, so n
    elements take n log n steps; appending to an array would take n squared.
    """
    other = f"get(a, i {'+' if ahead else '-'} shiftleft(1, j))"
    return let("vs", values, f"aggregate(sequence(0, cast(log2(size(vs) + 1) as int)), vs, (a, j) -> transform(a, (v, i) -> {step.format(w=other)}))")


def found(text: str, pattern: str) -> str:
    """SQL for the leftmost non-overlapping matches of ``pattern``.

    Gives array<struct<s, e, m>>: code-point start, exclusive end, matched
    text. The pieces between matches (``split``) and the matches themselves
    (``regexp_extract_all``) alternate, so running lengths are the offsets.
    """
    p = pattern.replace("\\", "\\\\").replace("'", "\\'")
    ends = running("transform(t.m, (x, i) -> length(t.p[i]) + length(x))", "v + coalesce({w}, 0)")
    spans = "transform(t.m, (x, i) -> named_struct('s', ends[i] - length(x), 'e', ends[i], 'm', x))"
    return let("t", f"named_struct('p', split({text}, '{p}', -1), 'm', regexp_extract_all({text}, '{p}', 0))", let("ends", ends, spans))


#: Code points in a block of ``blocks``.
BLOCK = 128


def blocks(text: str) -> str:
    """SQL for the text cut into blocks, in which ``part`` finds a place without reading from the start."""
    return f"regexp_extract_all({text}, '(?s).{{1,{BLOCK}}}', 0)"


def part(cut: str, start: str, end: str) -> str:
    """SQL for the code points from ``start`` up to ``end`` of a text cut into ``blocks``."""
    first = f"cast({start} div {BLOCK} as int)"
    return (f"substring(array_join(slice({cut}, {first} + 1, cast({end} div {BLOCK} as int) - {first} + 1), ''), "
            f"{start} % {BLOCK} + 1, {end} - {start})")


EMPTY_SPANS = "cast(array() as array<struct<s:int,e:int,m:string>>)"


def ship(spark: SparkSession, model: object):
    """Broadcast a bounded model with its class, which executors need not have."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def shipped(shared) -> object:
    """The model of ``ship`` inside a task."""
    return pickle.loads(shared.value)
