"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()  # of the tables written here


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only a local
    session without that setting (tests) gets a scratch folder of its own."""
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if path:
        return path
    master = spark.conf.get("spark.master", "local")
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tessera-llm-")
    spark.conf.set(CHECKPOINT_CONF, path)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage
    ends there, and a lost executor costs only the tasks it was running."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[back] = path
    return back


def remove(df: DataFrame) -> None:
    """Delete the table that :func:`cut` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(df))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has, whatever its case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row. A plain column
    reference inside a lambda may be inlined by the optimizer and then be
    evaluated for every element; a lambda variable is not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def doc_hash(col: str | Column) -> Column:
    """UTF-8 crc32 of the decimal form of an id; NULL for a NULL id."""
    return F.crc32(F.col(col).cast("string").cast("binary") if isinstance(col, str) else col)


def sliding(values: Column, width: int, join: Callable[[Column, Column], Column]) -> Column:
    """``join`` over every window of ``width`` elements, by doubling: a window
    is joined from two shorter ones that cover it together (they may overlap).
    Empty if there are fewer elements."""
    def grow(cur: Column, size: int) -> Column:
        if size == width:
            return cur
        step = min(size, width - size)
        return let(F.zip_with(cur, F.slice(cur, step + 1, F.size(cur)), lambda a, b: join(a, b)), lambda longer: grow(longer, size + step))

    return let(values, lambda v: F.slice(grow(v, 1), F.lit(1), F.greatest(F.size(v) - (width - 1), F.lit(0))))


def not_in(codes: list[int]) -> str:
    """Regular expression for runs without these characters. They are listed
    one by one: Java looks such a class up in a table, ranges it tests in turn."""
    return "[^" + "".join(f"\\x{c:02X}" for c in codes) + "]+"


#: Runs without ASCII white space.
WORD = not_in([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
