from pyspark.sql import functions as F

from tessera.functions import paths as PA
from conftest import rows


def test_tile_and_scene_ids(spark):
    df = spark.createDataFrame([("S2A_MSIL2A_20170613T101031_N9999_R022_T33UUP_26_57",
                                 "S1A_IW_GRDH_1SDV_20170613T165043_33UUP_26_57"),
                                ("no_suffix", None)], "patch_id string, s1_name string")
    out = rows(df.select(PA.tile_id("patch_id").alias("t"), PA.scene_id("s1_name").alias("s")))
    assert out[0] == ("S2A_MSIL2A_20170613T101031_N9999_R022_T33UUP", "S1A_IW_GRDH_1SDV_20170613T165043")
    assert out[1] == (None, None)  # regex miss and NULL name -> NULL, not '' and not an error


def test_derive_paths_and_error_flag(spark):
    df = spark.createDataFrame([("T_1_2", "S1_X_AB12_1_2"), ("bad", "S1_X_AB12_1_2")],
                               "patch_id string, s1_name string")
    out = {r["patch_id"]: r for r in PA.derive_paths(df, "s3://root/").collect()}
    assert out["bad"]["s2_path"] is None and out["bad"]["path_error"]
    good = out["T_1_2"]
    assert good["s2_path"] == "s3://root/BigEarthNet-S2/T/T_1_2/" and not good["path_error"]
    assert good["label_path"] == "s3://root/Reference_Maps/T/T_1_2/"
    assert good["s1_path"] == "s3://root/BigEarthNet-S1/S1_X/S1_X_AB12_1_2/"


def test_strip_scheme(spark):
    df = spark.createDataFrame([("s3://b/x/",), ("gs://b/x/",), (None,)], "p string")
    assert rows(df.select(PA.strip_scheme("p"))) == [("b/x/",), (None,), (None,)]


def test_band_file_needs_trailing_slash(spark):
    df = spark.createDataFrame([("b/T/P_1_2/",), ("b/T/P_1_2",)], "p string")
    assert rows(df.select(PA.band_file("p", "VV"))) == [("b/T/P_1_2/P_1_2_VV.tif",), (None,)]


def test_band_files_named_order(spark):
    df = spark.createDataFrame([("a/S1/ b/S2/ c/L/",)], "paths string")
    r = df.select(PA.band_files("paths").alias("f")).collect()[0]["f"]
    assert r["s1"] == ["a/S1/S1_VV.tif", "a/S1/S1_VH.tif"]
    assert r["s2"] == [f"b/S2/S2_{b}.tif" for b in ("B02", "B03", "B04", "B08")]
    assert r["label"] == ["c/L/L_reference_map.tif"]


def test_paths_string_roundtrip_and_null(spark):
    df = spark.createDataFrame([("a/", "b/", "c/"), ("a/", None, "c/")], "s1 string, s2 string, l string")
    s = df.select(PA.paths_string("s1", "s2", "l").alias("p"))
    out = s.select(PA.split_paths_string("p").alias("x")).collect()
    assert tuple(out[0]["x"]) == ("a/", "b/", "c/")
    assert rows(s) [1] == (None,)


def test_band_filter_regex(spark):
    names = [f"d/P_{b}.tif" for b in ("B01", "B02", "B03", "B04", "B05", "B08", "B8A", "B11")] + ["d/P_B02xtif"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    kept = sorted(r[0] for r in rows(df.filter(PA.is_s2_band_file("path")).select(PA.band_name("path"))))
    assert kept == ["B02", "B03", "B04", "B08"]


def test_add_scheme_roundtrip(spark):
    df = spark.createDataFrame([("b/x/",)], "p string")
    out = df.select(PA.strip_scheme(PA.add_scheme("p")).alias("r")).collect()[0]["r"]
    assert out == "b/x/"
