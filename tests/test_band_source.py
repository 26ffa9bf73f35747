import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.operators import batches as BA
from tessera.operators import models as MO
from tessera.operators import rasters as RA
from tessera.operators import sampling as S
from tessera.operators.assembly import assemble
from tessera.operators.tiles import DEFAULT_BANDS, decode_stack, pivot_bands
from tessera.plans import workflows as W
from tessera.schemas import CODES
from tessera.sources import bandsource as BS
from tessera.sources import tilestore as TS

SIZE = 6


def patch_files(root, n, seed=1):
    """n patches of SIZE x SIZE; the red band tells the class. Returns meta rows."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        pid, s1 = f"T_{k}_1", f"S1X_{k}_1"
        label = rng.choice(CODES[:3], (1, SIZE, SIZE)).astype(np.uint16)
        red = (np.searchsorted(CODES[:3], label) * 1000 + rng.integers(0, 50, label.shape)).astype(np.uint16)
        for sub, d, band, arr in [("S1", s1, "VV", -rng.random((1, SIZE, SIZE)).astype(np.float32)), ("S1", s1, "VH", -1 - rng.random((1, SIZE, SIZE)).astype(np.float32)),
                                  ("S2", pid, "B02", red // 2 + 1), ("S2", pid, "B03", red // 3 + 1), ("S2", pid, "B04", red + 1), ("S2", pid, "B08", red * 2 + 7),
                                  ("S2", pid, "B05", red), ("L", pid, "reference_map", label)]:
            os.makedirs(f"{root}/{sub}/tile/{d}", exist_ok=True)
            np.save(f"{root}/{sub}/tile/{d}/{d}_{band}.npy", arr)
        rows.append((pid, s1, "train" if k % 3 else "test"))
    return rows


def meta_frame(spark, rows):
    return spark.createDataFrame(rows, "patch_id string, s1_name string, split string")


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bands"))
    return root, patch_files(root, 30)


def logging_decoder(log):
    def decode(data, path):
        with open(log, "a") as f:
            f.write(path + "\n")
        return BS.decode_npy(data, path)

    return decode


@pytest.mark.parametrize("max_pushed", [BS.MAX_PUSHED, 2])
def test_a_sample_opens_only_its_files(spark, files, tmp_path, max_pushed):
    root, rows = files
    meta = meta_frame(spark, rows)
    sample = meta.filter(F.col("patch_id").isin("T_3_1", "T_17_1"))
    log = str(tmp_path / "opened")
    tiles = BS.ingest_rasters(spark, root, sample, logging_decoder(log), max_pushed=max_pushed)
    got = tiles.collect()
    assert len(got) == 14 and {r["patch_id"] for r in got} == {"T_3_1", "T_17_1"} and all(r["error"] is None for r in got)
    with open(log) as f:
        paths = [x.strip() for x in f]
    assert len(paths) == 14 and all("_3_1" in p or "_17_1" in p for p in paths) and not any("B05" in p for p in paths)


def test_filters_are_pushed_and_partitions_packed(spark, files):
    root, _ = files
    df = BS.read_band_files(spark, root, max_partition_bytes=3000, open_cost_bytes=100)
    assert df.count() == 240 and df.rdd.getNumPartitions() > 10
    some = df.filter("band = 'VV' AND dir_name IN ('S1X_0_1', 'S1X_5_1', 'nowhere')")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "Filter" not in plan.split("BatchScan")[0]
    assert some.rdd.getNumPartitions() == 1 and some.count() == 2
    assert df.filter("band = 'VV' AND band IN ('VH')").count() == 0
    assert df.filter("band LIKE 'B0%' AND size > 0").count() == 150
    parts = BS.pack_by_size([("d", "b", str(i), s) for i, s in enumerate([10, 10, 500, 10, 10])], 30, 5)
    assert [len(p.rows) for p in parts] == [2, 1, 2]


def test_bad_files_are_rows(spark, tmp_path):
    root = str(tmp_path)
    rows = patch_files(root, 2)
    with open(f"{root}/S2/tile/T_0_1/T_0_1_B03.npy", "wb") as f:
        f.write(b"no raster")
    np.save(f"{root}/S2/tile/T_1_1/T_1_1_B04.npy", np.ones((2, SIZE, SIZE), np.uint16))
    np.save(f"{root}/S2/tile/T_1_1/T_1_1_B08.npy", np.ones((SIZE, SIZE - 1), np.uint16))
    tiles = BS.ingest_rasters(spark, root, meta_frame(spark, rows))
    bad = tiles.filter("error IS NOT NULL").collect()
    assert len(bad) == 1 and bad[0]["raster"] is None and bad[0]["path"].endswith("B03.npy")
    out = {r["patch_id"]: r for r in W.materialize_patches(meta_frame(spark, rows), tiles, SIZE, SIZE).collect()}
    assert out["T_0_1"]["reject_reason"] == "missing:B03" or out["T_0_1"]["reject_reason"] == "missing:G"
    assert out["T_0_1"]["bands"] is None and out["T_0_1"]["missing_bands"] == ["B03"] and len(out["T_0_1"]["label_map"]) == SIZE * SIZE * 2
    assert out["T_1_1"]["reject_reason"] == "planes:R" and out["T_1_1"]["missing_bands"] == ["B04", "B08"]


def test_stack_keeps_the_rasters_dtypes(spark, files):
    root, rows = files
    meta = meta_frame(spark, rows[:4])
    out = W.materialize_patches(meta, BS.ingest_rasters(spark, root, meta), SIZE, SIZE).collect()
    assert {(r["dtype"], r["label_map_dtype"], r["channels"], r["n_copies"]) for r in out} == {("float32", "uint16", 6, 0)}
    for r in out:
        k = r["patch_id"].split("_")[1]
        got = decode_stack(r["bands"], r["dtype"], 6, SIZE, SIZE)
        want = [np.load(f"{root}/S1/tile/S1X_{k}_1/S1X_{k}_1_{b}.npy") for b in ("VV", "VH")] + [np.load(f"{root}/S2/tile/T_{k}_1/T_{k}_1_{b}.npy") for b in ("B02", "B03", "B04", "B08")]
        assert got.dtype == np.concatenate(want).dtype and (got[:, 0] == np.concatenate(want)).all()
        assert r["label_map"] == np.load(f"{root}/L/tile/T_{k}_1/T_{k}_1_reference_map.npy").tobytes()


def test_files_to_accuracy(spark, files, tmp_path):
    root, rows = files
    meta = meta_frame(spark, rows)
    log = str(tmp_path / "opened")
    res = W.classify_files(spark, root, meta, fraction=0.8, num_trees=5, decoder=logging_decoder(log))
    assert res.accuracy > 0.97 and res.test_patches > 3
    chosen = S.stratified_sample(meta, "split", {"train": 0.8, "test": 0.8}, ["patch_id"])
    assert res.train_patches + res.test_patches == chosen.count() < 30
    keys = {k for r in chosen.collect() for k in (r["patch_id"], r["s1_name"])}
    with open(log) as f:
        assert {p.strip().split("/")[-2] for p in f} == keys
    px = RA.raster_pixels(RA.assemble_rasters(BS.ingest_rasters(spark, root, chosen)))
    assert px.count() == chosen.count() * SIZE * SIZE and dict(px.dtypes)["R"] == "bigint" and dict(px.dtypes)["VV"] == "double"


def test_assembly_plan_and_copies(spark):
    tiles = spark.createDataFrame([("p", b, [float(i)] * 4, i) for i, b in enumerate(["VV", "VH", "B02"])] + [("q", "VV", None, 1)]
                                  + [("p", "VV", [9.0] * 4, c) for c in range(10, 40)], "patch_id string, band string, pixels array<double>, copy int")
    wide = assemble(tiles, "pixels", ["VV", "VH", "B02", "B03"], tie="copy")
    got = {r["patch_id"]: r for r in wide.collect()}
    assert got["p"]["VV"] == [0.0] * 4 and got["p"]["B03"] is None and got["p"]["n_copies"] == 30 and got["q"]["VV"] is None and got["q"]["n_copies"] == 0
    plan = pivot_bands(tiles)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1
    fixed = pivot_bands(tiles, partitions=7)
    assert fixed._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1 and fixed.rdd.getNumPartitions() == 7
    for n in (1, 3):
        last = assemble(tiles.repartition(n), "pixels", ["VV", "VH", "B02", "B03"], tie=-F.col("copy"), reduce_copies=n == 1)
        assert {r["patch_id"]: (r["VV"], r["n_copies"]) for r in last.collect()}["p"] == ([9.0] * 4, 30)


@pytest.fixture
def tables(spark):
    names = ["tessera_test_tiles", "tessera_test_elements"]
    yield names
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_tile_store_needs_no_exchange(spark, tables, files):
    root, rows = files
    meta = meta_frame(spark, rows)
    TS.write_store(BS.ingest_rasters(spark, root, meta), tables[0], 4, order=["band"])
    elements = BA.shard(BA.element_order(meta.select("patch_id", "split").unionByName(spark.createDataFrame([("lost", "test")], "patch_id string, split string")),
                                         "split", ["patch_id"]), 2).select("patch_id", "split", "shard", "shard_pos")
    TS.write_store(elements, tables[1], 4)
    plain = RA.assemble_rasters(spark.table(tables[0]), reduce_copies=False)
    train = RA.stack(RA.assemble_rasters(TS.training_rows(spark, *tables), reduce_copies=False, keep=("split", "shard", "shard_pos")),
                     keep=("split", "shard", "shard_pos"))
    for df in (plain, train):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    got = train.collect()
    assert len(got) == 31 and {r["patch_id"] for r in got if r["bands"] is None} == {"lost"}


def test_shard_files_are_in_order(spark, tmp_path):
    rows = [(f"p{i}", "train" if i % 4 else "test") for i in range(400)]
    ordered = BA.shard(BA.element_order(spark.createDataFrame(rows, "patch_id string, split string"), "split", ["patch_id"]), 3)
    path = str(tmp_path / "shards")
    TS.write_shards(ordered.select("patch_id", "split", "shard", "shard_pos"), path, files_per_shard=3)
    for shard in range(3):
        folder = f"{path}/split=train/shard={shard}"
        names = sorted(x for x in os.listdir(folder) if x.endswith(".parquet"))
        seen = [p for x in names for p in pq.ParquetFile(f"{folder}/{x}").read(["shard_pos"]).column(0).to_pylist()]
        assert seen == list(range(100))
    one = TS.read_shard(spark, path, split="train", shard=1)
    assert [r["shard_pos"] for r in one.collect()] == list(range(100))
    assert "PartitionFilters: [isnotnull(split" in one._jdf.queryExecution().executedPlan().toString()


def test_pack_refuses_what_does_not_fit(spark):
    rows = [("a", "uint16", 1, 2, [1.0, 2.0]), ("b", "uint16", 1, 2, [1.0, 2.5]), ("c", "uint16", 1, 2, [1.0, -1.0]), ("d", "float32", 1, 2, [1.0, 2.5]),
            ("e", "float32", 1, 2, [1.0, None]), ("f", "float32", 1, 2, [1.0]), ("g", None, 1, 2, [1.0, 1.0]), ("h", "float32", 1, 2, None)]
    df = spark.createDataFrame(rows, "patch_id string, dtype string, height int, width int, pixels array<double>")
    got = {r["patch_id"]: r["raster"] for r in RA.pack(df).collect()}
    assert {k for k, v in got.items() if v is not None} == {"a", "d"}
    assert RA.values_of(got["a"].asDict()).tolist() == [1, 2] and got["a"]["data"] == b"\x01\x00\x02\x00"
