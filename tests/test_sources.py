import os

import numpy as np
from pyspark.sql import functions as F

from tessera.sources import bandfiles as BF
from tessera.sources import metadata as MD
from tessera.sources import sinks as SK
from tessera.schemas import METADATA_M1


def _write_patch(root, patch_id, s1_name, h=3, w=2, bad=None, skip=()):
    rng = np.random.default_rng(abs(hash(patch_id)) % 1000)
    layout = {"S1": (s1_name, ["VV", "VH"], np.float32), "S2": (patch_id, ["B02", "B03", "B04", "B08", "B05"],
                                                              np.uint16),
              "L": (patch_id, ["reference_map"], np.uint16)}
    for sub, (dname, bands, dt) in layout.items():
        d = os.path.join(root, sub, "tile", dname)
        os.makedirs(d, exist_ok=True)
        for b in bands:
            if b in skip:
                continue
            path = os.path.join(d, f"{dname}_{b}.npy")
            if b == bad:
                with open(path, "wb") as f:
                    f.write(b"not a raster")
                continue
            np.save(path, (rng.random((1, h, w)) * 100).astype(dt))


def test_ingest_decode_and_key(spark, tmp_path):
    root = str(tmp_path / "data")
    _write_patch(root, "T_1_1", "S1X_1_1")
    _write_patch(root, "T_1_2", "S1X_1_2", bad="B03", skip=("VH",))
    meta = spark.createDataFrame([("T_1_1", "S1X_1_1"), ("T_1_2", "S1X_1_2")], "patch_id string, s1_name string")
    tiles = BF.ingest_band_files(spark, root, meta)
    got = {(r["patch_id"], r["band"]): r for r in tiles.collect()}
    assert got[("T_1_1", "VV")]["height"] == 3 and len(got[("T_1_1", "VV")]["pixels"]) == 6
    assert got[("T_1_1", "B04")]["dtype"] == "uint16" and ("T_1_1", "B05") not in got
    assert len(got[("T_1_1", "reference_map")]["pixels"]) == 6
    assert got[("T_1_2", "B03")]["pixels"] is None and "Error" in got[("T_1_2", "B03")]["error"]
    assert ("T_1_2", "VH") not in got
    assert len([k for k in got if k[0] == "T_1_1"]) == 7
    every = BF.ingest_band_files(spark, root, meta.filter("patch_id = 'T_1_1'"), bands=None)
    assert sorted({(r["patch_id"], r["band"]) for r in every.select("patch_id", "band").collect()})[3] == ("T_1_1", "B05")
    assert every.count() == 8


def test_decode_keeps_every_raster_band(spark, tmp_path):
    arr = np.arange(12, dtype=np.uint16).reshape(2, 3, 2)
    np.save(str(tmp_path / "two.npy"), arr)
    row = BF.decode_band_files(BF.list_band_files(spark, str(tmp_path))).collect()[0]
    assert (row["height"], row["width"], row["error"]) == (3, 2, None)
    assert row["pixels"] == [float(x) for x in range(12)]


def test_file_of_two_raster_bands_is_reported(spark, tmp_path):
    from tessera.plans.workflows import materialize_patches
    root = str(tmp_path / "data")
    _write_patch(root, "T_3_1", "S1X_3_1")
    np.save(os.path.join(root, "S2", "tile", "T_3_1", "T_3_1_B03.npy"), np.ones((2, 3, 2), np.uint16))
    meta = spark.createDataFrame([("T_3_1", "S1X_3_1", "train")], "patch_id string, s1_name string, split string")
    row = materialize_patches(meta, BF.ingest_band_files(spark, root, meta), 3, 2).collect()[0]
    assert row["bands"] is None and row["label_map"] is not None and row["missing_bands"] == ["B03"]


def test_glob_keeps_model_bands(spark, tmp_path):
    root = str(tmp_path / "data")
    _write_patch(root, "T_2_1", "S1X_2_1")
    files = BF.list_band_files(spark, os.path.join(root, "S2"), glob="*_B0[2348].npy")
    names = sorted(os.path.basename(r[0]) for r in files.select("path").collect())
    assert names == [f"T_2_1_{b}.npy" for b in ("B02", "B03", "B04", "B08")]


def test_raw_decoder(spark):
    arr = np.arange(6, dtype="<u2")
    out = BF.raw_decoder("uint16", 2, 3)(arr.tobytes(), "x")
    assert out.shape == (1, 2, 3) and out[0, 1, 2] == 5


def test_read_metadata_prunes_and_pushes(spark, tmp_path):
    p = str(tmp_path / "meta")
    spark.createDataFrame([("a", "train", "s3://x/1/", "s3://x/2/", "s3://x/3/", "extra")],
                          "patch_id string, split string, s1_path string, s2_path string, label_path string, "
                          "country string").write.parquet(p)
    df = MD.read_metadata(spark, p, METADATA_M1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "country" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert "In(split" in plan
    prepared = MD.prepare_paths(df).collect()[0]
    assert prepared["paths_array"] == ["x/1/", "x/2/", "x/3/"]


def test_assert_not_null(spark):
    df = spark.createDataFrame([("a",), (None,)], "x string")
    import pytest
    with pytest.raises(Exception):
        MD.assert_not_null(df, ["x"]).collect()
    assert MD.assert_not_null(df.filter("x is not null"), ["x"]).count() == 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "train", b"\x00"), ("b", "test", b"\x01")],
                               "patch_id string, split string, bands binary")
    p = str(tmp_path / "patches")
    SK.write_patches(df, p)
    assert sorted(os.listdir(p))[:2] == ["_SUCCESS", "split=test"] or "split=train" in os.listdir(p)
    back = spark.read.parquet(p).filter(F.col("split") == "train")
    assert back.count() == 1 and "PartitionFilters" in back._jdf.queryExecution().executedPlan().toString()
    r = str(tmp_path / "runs")
    SK.append_run_metrics(spark.createDataFrame([("r", 1)], "run string, x int"), r)
    SK.append_run_metrics(spark.createDataFrame([("r", 2)], "run string, x int"), r)
    assert spark.read.parquet(r).count() == 2
