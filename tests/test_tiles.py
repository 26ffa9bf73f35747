import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import tiles as TL
from conftest import rows

TILE_DDL = "patch_id string, band string, pixels array<double>"


def _tiles(spark, data):
    return spark.createDataFrame(data, TILE_DDL)


def _full(pid, n=4, base=0.0):
    bands = ["VV", "VH", "B02", "B03", "B04", "B08", "reference_map"]
    return [(pid, b, [base + 10 * i + j for j in range(n)]) for i, b in enumerate(bands)]


def test_pivot_types_and_missing(spark):
    data = _full("p1") + [r for r in _full("p2") if r[1] != "B03"]
    p = TL.pivot_bands(_tiles(spark, data)).orderBy("patch_id").collect()
    assert p[0]["VV"] == [0.0, 1.0, 2.0, 3.0] and p[0]["B"] == [20, 21, 22, 23]
    assert p[0]["label"] == [60, 61, 62, 63]
    assert p[1]["G"] is None and p[1]["R"] == [40, 41, 42, 43]


def test_pivot_duplicate_band_is_deterministic(spark):
    data = _full("p1") + [("p1", "VV", [9.0, 9.0, 9.0, 9.0])]
    a = TL.pivot_bands(_tiles(spark, data).repartition(1)).collect()[0]["VV"]
    b = TL.pivot_bands(_tiles(spark, list(reversed(data))).repartition(3)).collect()[0]["VV"]
    assert a == b == [0.0, 1.0, 2.0, 3.0]


def test_missing_bands(spark):
    data = [r for r in _full("p2") if r[1] not in ("B03", "reference_map")] + _full("p1")
    out = TL.missing_bands(_tiles(spark, data)).orderBy("patch_id").collect()
    assert out[0]["missing_bands"] == [] and out[1]["missing_bands"] == ["B03", "reference_map"]


def test_explode_row_count_and_null(spark):
    data = _full("p1", 5) + [r for r in _full("p2") if r[1] != "B08"]
    px = TL.explode_pixels(TL.pivot_bands(_tiles(spark, data)))
    assert px.count() == 5  # the patch missing a band contributes no pixels
    assert rows(px.filter("pos = 2"), "patch_id", "VV", "NIR", "label") == [("p1", 2.0, 52, 62)]


def test_explode_unequal_lengths(spark):
    data = _full("p1", 4)
    data[0] = ("p1", "VV", [1.0, 2.0])
    p = TL.pivot_bands(_tiles(spark, data))
    padded = TL.explode_pixels(p)
    assert padded.count() == 4 and padded.filter(F.col("VV").isNull()).count() == 2
    assert TL.explode_pixels(p, check_sizes=True).count() == 0


def test_interleave_channels_last(spark):
    p = TL.pivot_bands(_tiles(spark, _full("p1", 3)))
    img = p.select(TL.interleave(dtype="double").alias("i")).collect()[0]["i"]
    arr = np.array(img).reshape(3, 6)  # (pixels, channels)
    assert arr[:, 0].tolist() == [0.0, 1.0, 2.0] and arr[:, 5].tolist() == [50.0, 51.0, 52.0]
    # splitting the interleaved image back by channel recovers every band
    stacked = p.select(TL.stack_channels().alias("s")).collect()[0]["s"]
    assert np.array(stacked).reshape(6, 3).T.tolist() == arr.tolist()


def test_shape_check(spark):
    df = spark.createDataFrame([([1.0] * 12,), ([1.0] * 11,), (None,)], "a array<double>")
    assert [r[0] for r in df.select(TL.shape_check(F.col("a"), 2, 2, 3)).collect()] == [True, False, False]


# --- resize: independent numpy reference of half-pixel-centre resizing ---

def _ref_nearest(img, oh, ow):
    ih, iw = img.shape
    sy, sx = np.float32(ih) / np.float32(oh), np.float32(iw) / np.float32(ow)
    ys = [min(int(np.floor((np.float32(y) + np.float32(0.5)) * sy)), ih - 1) for y in range(oh)]
    xs = [min(int(np.floor((np.float32(x) + np.float32(0.5)) * sx)), iw - 1) for x in range(ow)]
    return img[np.ix_(ys, xs)]


def _ref_bilinear(img, oh, ow):
    img = img.astype(np.float32)
    ih, iw = img.shape

    def coords(n_in, n_out):
        s = np.float32(n_in) / np.float32(n_out)
        out = []
        for i in range(n_out):
            v = (np.float32(i) + np.float32(0.5)) * s - np.float32(0.5)
            f = np.float32(np.floor(v))
            out.append((max(int(f), 0), min(int(np.ceil(v)), n_in - 1), np.float32(v - f)))
        return out

    res = np.zeros((oh, ow), np.float32)
    for y, (y0, y1, yl) in enumerate(coords(ih, oh)):
        for x, (x0, x1, xl) in enumerate(coords(iw, ow)):
            tl, tr, bl, br = img[y0, x0], img[y0, x1], img[y1, x0], img[y1, x1]
            top = np.float32(tl + (tr - tl) * xl)
            bot = np.float32(bl + (br - bl) * xl)
            res[y, x] = np.float32(top + (bot - top) * yl)
    return res


@pytest.mark.parametrize("ih,iw,oh,ow", [(8, 8, 12, 12), (5, 7, 3, 4), (6, 6, 6, 6), (4, 6, 9, 5)])
def test_resize_matches_reference(spark, ih, iw, oh, ow):
    rng = np.random.default_rng(ih * 100 + ow)
    img = rng.normal(size=(ih, iw)).astype(np.float32)
    df = spark.createDataFrame([(img.reshape(-1).astype(float).tolist(),)], "a array<double>")
    r = df.select(TL.resize_nearest("a", ih, iw, oh, ow).alias("n"),
                  TL.resize_bilinear("a", ih, iw, oh, ow).alias("b")).collect()[0]
    assert np.array(r["n"]).reshape(oh, ow).tolist() == _ref_nearest(img, oh, ow).astype(float).tolist()
    got = np.array(r["b"], dtype=np.float32).reshape(oh, ow)
    assert np.array_equal(got, _ref_bilinear(img, oh, ow))


def test_resize_identity_and_bad_size(spark):
    df = spark.createDataFrame([([float(i) for i in range(16)],), ([1.0, 2.0],)], "a array<double>")
    out = df.select(TL.resize_nearest("a", 4, 4, 4, 4).alias("n")).collect()
    assert out[0]["n"] == [float(i) for i in range(16)] and out[1]["n"] is None


def test_stack_bytes_roundtrip(spark):
    data = _full("p1", 4) + [r for r in _full("p2", 4) if r[1] != "VH"]
    p = TL.pivot_bands(_tiles(spark, data))
    st = {r["patch_id"]: r for r in TL.stack_bytes(p, 2, 2).collect()}
    a = TL.decode_stack(st["p1"]["bands"], st["p1"]["dtype"], 6, 2, 2)
    assert a.shape == (6, 1, 2, 2) and a[0, 0].reshape(-1).tolist() == [0.0, 1.0, 2.0, 3.0]
    assert a[2, 0, 1, 1] == 23.0 and st["p1"]["dtype"] == "float64"
    assert st["p2"]["bands"] is None and st["p2"]["channels"] is None


def test_label_bytes_and_repartition(spark):
    p = TL.repartition_by_patch(TL.pivot_bands(_tiles(spark, _full("p1", 4))), 4)
    assert p.rdd.getNumPartitions() == 4
    st = TL.stack_bytes(p, 2, 2, channels=("label",)).collect()[0]
    arr = TL.decode_stack(st["bands"], st["dtype"], 1, 2, 2)
    assert st["dtype"] == "int64" and arr.reshape(-1).tolist() == [60, 61, 62, 63]


@pytest.mark.parametrize("method", ["bilinear", "nearest"])
def test_arrow_resize_matches_native(spark, method):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=30) * 100).tolist()) for i in range(5)] + [(5, [1.0, 2.0]), (6, None)]
    df = spark.createDataFrame(rows, "id int, a array<double>")
    native = TL.resize_bilinear if method == "bilinear" else TL.resize_nearest
    exp = {r["id"]: r["r"] for r in df.select("id", native("a", 5, 6, 7, 4).cast("array<float>").alias("r"))
           .collect()}
    got = {r["id"]: r["a"] for r in TL.resize_columns(df, ["a"], 5, 6, 7, 4, method).collect()}
    assert got == exp and got[5] is None and got[6] is None


@pytest.mark.parametrize("method", ["bilinear", "nearest"])
def test_arrow_resize_null_elements(spark, method):
    vals = [float(i) for i in range(30)]
    vals[7] = None
    df = spark.createDataFrame([(0, vals)], "id int, a array<double>")
    native = TL.resize_bilinear if method == "bilinear" else TL.resize_nearest
    exp = df.select(native("a", 5, 6, 10, 12).cast("array<float>").alias("r")).collect()[0]["r"]
    got = TL.resize_columns(df, ["a"], 5, 6, 10, 12, method).collect()[0]["a"]
    assert got == exp and None in got


def test_stack_bytes_null_pixel_is_all_or_nothing(spark):
    data = _full("p1", 4) + _full("p2", 4)
    data = [(p, b, [None, 1.0, 2.0, 3.0]) if (p, b) == ("p2", "B03") else (p, b, px) for p, b, px in data]
    st = {r["patch_id"]: r for r in TL.stack_bytes(TL.pivot_bands(_tiles(spark, data)), 2, 2).collect()}
    assert st["p1"]["bands"] is not None and st["p2"]["bands"] is None
