import os
import tempfile

from tessera.operators import labels as L
from tessera.schemas import LABEL_DICTIONARY
from conftest import rows


def _px(spark):
    return spark.createDataFrame([("p", 0, 111), ("p", 1, 999), ("p", 2, 0), ("q", 0, 523), ("q", 1, 0)],
                                 "patch_id string, pos int, label bigint")


def test_recode_sparse_and_dense(spark):
    d = L.label_dictionary(spark)
    sparse = sorted(rows(L.recode_labels(_px(spark), d, target="ID_NEW"), "pos", "label"))
    assert sparse == [(0, 1), (0, 44), (1, 99)]
    dense = sorted(rows(L.recode_labels(_px(spark), d, target="CLASS"), "patch_id", "label"))
    assert dense == [("p", 0), ("p", 44), ("q", 43)]


def test_recode_is_broadcast(spark):
    plan = L.recode_labels(_px(spark), L.label_dictionary(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_unmatched_audit(spark):
    out = rows(L.unmatched_labels(_px(spark), L.label_dictionary(spark)), "code", "n_pixels", "n_patches")
    assert out == [(0, 2, 2)]


def test_encode_dense_both_forms(spark):
    d = L.label_dictionary(spark)
    rel = sorted(rows(L.encode_dense(_px(spark), d), "patch_id", "pos", "class_id"))
    assert rel == [("p", 0, 0), ("p", 1, 44), ("p", 2, None), ("q", 0, 43), ("q", 1, None)]
    arr = spark.createDataFrame([([111, 0, 999],)], "a array<bigint>").select(L.encode_dense_array("a"))
    assert arr.collect()[0][0] == [0, None, 44]


def test_read_csv_with_bom_crlf(spark):
    d = tempfile.mkdtemp(prefix="tessera-dict-")
    path = os.path.join(d, "label_encoding.csv")
    with open(path, "wb") as f:
        f.write("﻿ID,ID_NEW,DESC\r\n".encode("utf-8"))
        for c, s, desc in LABEL_DICTIONARY:
            f.write(f"{c},{s},{desc}\r\n".encode("utf-8"))
    df = L.read_label_dictionary(spark, path)
    got = sorted(rows(df, "ID", "ID_NEW", "CLASS"))
    assert len(got) == 45 and got[0] == (111, 1, 0) and got[-1] == (999, 99, 44)
