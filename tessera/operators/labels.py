"""Land-cover label dictionary, recoding and audits.

The built-in dictionary is a local relation of 45 rows: its plan proves the
size, so joining against it is a broadcast hash join. Dictionaries from files get no hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.schemas import DENSE_IDS, LABEL_DICT_CSV, LABEL_DICTIONARY

MAX_DICTIONARY_ROWS = 10_000   # broadcast guard for user-supplied dictionaries


def label_dictionary(spark: SparkSession) -> DataFrame:
    """(ID int, ID_NEW int, DESC string, CLASS int): sparse and dense ids.
    A local relation (SQL VALUES): no Python-side RDD, known tiny size."""
    def q(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"
    values = ", ".join(f"({c}, {s}, {q(d)}, {DENSE_IDS[c]})" for c, s, d in LABEL_DICTIONARY)
    return spark.sql(f"SELECT CAST(ID AS INT) AS ID, CAST(ID_NEW AS INT) AS ID_NEW, DESC, "
                     f"CAST(CLASS AS INT) AS CLASS FROM VALUES {values} AS t(ID, ID_NEW, DESC, CLASS)")


def read_label_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Typed read of the dictionary CSV (header, UTF-8 BOM and CRLF tolerated).
    Adds the dense CLASS id: 0..n-1 in file order, whatever the codes are. A
    dictionary is one small file; more than ``MAX_DICTIONARY_ROWS`` raise when it is used."""
    df = spark.read.schema(LABEL_DICT_CSV).option("header", True).option("encoding", "UTF-8").csv(path).coalesce(1)
    place = F.monotonically_increasing_id()
    checked = df.withColumn("CLASS", place).filter(F.col("ID").isNotNull())
    fits = F.assert_true(F.col("CLASS") < MAX_DICTIONARY_ROWS, F.lit(f"dictionary of over {MAX_DICTIONARY_ROWS} rows"))
    return checked.filter(fits.isNull()).withColumn("CLASS", F.col("CLASS").cast("int"))


def proven_rows(df: DataFrame) -> int | None:
    """The most rows that the plan itself proves (a local relation, a limit,
    a range...), without running anything; None if it proves none."""
    most = df._jdf.queryExecution().optimizedPlan().maxRows()
    return int(most.get()) if most.isDefined() else None


def _guarded_broadcast(dictionary: DataFrame, checked_rows: int | None) -> DataFrame:
    """Broadcast the dictionary only where its size is proven: by its plan, or
    by ``checked_rows`` that the caller counted. Otherwise no hint is given and Spark decides from
    its statistics. A proof of too many rows raises."""
    rows = proven_rows(dictionary) if checked_rows is None else checked_rows
    if rows is None:
        return dictionary
    if rows > MAX_DICTIONARY_ROWS:
        raise ValueError(f"dictionary of {rows} rows is too large to broadcast")
    return F.broadcast(dictionary)


def recode_labels(pixels: DataFrame, dictionary: DataFrame, label_col: str = "label",
                  target: str = "ID_NEW", dictionary_rows: int | None = None) -> DataFrame:
    """Inner equi-join pixel.label = dictionary.ID; the label becomes the
    dictionary's ``target`` id as bigint. Pixels with unknown codes are
    dropped (see :func:`unmatched_labels` for the audit)."""
    d = _guarded_broadcast(dictionary.select(F.col("ID").cast("bigint").alias("_code"),
                                             F.col(target).cast("bigint").alias("_new")),
                           dictionary_rows)
    cols = [c for c in pixels.columns if c != label_col]
    return (pixels.join(d, pixels[label_col] == d["_code"], "inner")
            .select(*cols, F.col("_new").alias(label_col)))


def unmatched_labels(pixels: DataFrame, dictionary: DataFrame, label_col: str = "label",
                     key: str = "patch_id",
                     dictionary_rows: int | None = None) -> DataFrame:
    """Audit of the rows the recode join drops: per unknown code, the number
    of pixels and patches (left-anti join, then one aggregation)."""
    d = _guarded_broadcast(dictionary.select(F.col("ID").cast("bigint").alias("_code")), dictionary_rows)
    missed = pixels.join(d, pixels[label_col] == d["_code"], "left_anti")
    return missed.groupBy(F.col(label_col).alias("code")).agg(
        F.count(F.lit(1)).alias("n_pixels"), F.count_distinct(key).alias("n_patches"))


def dense_class_map() -> Column:
    """map<code, dense id> literal (45 entries)."""
    return F.create_map(*[x for c, i in DENSE_IDS.items() for x in (F.lit(c).cast("bigint"), F.lit(i))])


def encode_dense_array(codes: str | Column) -> Column:
    """Element-wise code -> dense id over a label array; unknown -> NULL."""
    arr = F.col(codes) if isinstance(codes, str) else codes
    m = dense_class_map()
    return F.transform(arr, lambda x: F.try_element_at(m, x.cast("bigint")))


def encode_dense(pixels: DataFrame, dictionary: DataFrame, label_col: str = "label",
                 out_col: str = "class_id",
                 dictionary_rows: int | None = None) -> DataFrame:
    """Relational form: broadcast LEFT join keeps every pixel; an unknown
    code gives a NULL class id."""
    d = _guarded_broadcast(dictionary.select(F.col("ID").cast("bigint").alias("_code"),
                                             F.col("CLASS").cast("int").alias(out_col)),
                           dictionary_rows)
    return pixels.join(d, pixels[label_col] == d["_code"], "left").drop("_code")
