import os
import time

from pyspark.sql import functions as F

from tessera.operators import models as MO
from tessera.operators.transformers import PixelExtractor
from tessera.plans import testbed as TB
from tessera.plans.queries import train_test_meta
from tessera.streaming import scoring as SC
from conftest import SF001


def _tiles_for(spark, ids):
    return TB.band_tiles(spark, SF001).filter(F.col("patch_id").isin(ids))


def test_assemble_across_batches_and_timeout(spark, tmp_path):
    src = str(tmp_path / "in")
    ids = [r[0] for r in TB.band_tiles(spark, SF001).select("patch_id").distinct().orderBy("patch_id")
           .limit(3).collect()]
    t = _tiles_for(spark, ids)
    # first arrival: S1 bands only; second arrival: the rest, except one patch's B08 + label
    t.filter(F.col("band").isin("VV", "VH")).write.mode("append").parquet(src)
    q1 = SC.assemble_patches(SC.read_tile_stream(spark, src), lateness_ms=1000) \
        .writeStream.format("memory").queryName("asm").outputMode("append") \
        .option("checkpointLocation", str(tmp_path / "ck")).start()
    q1.processAllAvailable()
    assert spark.sql("select * from asm").count() == 0  # nothing complete yet
    rest = t.filter(~F.col("band").isin("VV", "VH"))
    rest.filter(~((F.col("patch_id") == ids[2]) & F.col("band").isin("B08", "reference_map"))) \
        .write.mode("append").parquet(src)
    q1.processAllAvailable()
    out = {r["patch_id"]: r for r in spark.sql("select * from asm").collect()}
    assert set(out) == {ids[0], ids[1]} and out[ids[0]]["missing_bands"] == []
    batch_pivot = {r["patch_id"]: r for r in
                   __import__("tessera.operators.tiles", fromlist=["x"]).pivot_bands(t).collect()}
    assert out[ids[0]]["NIR"] == batch_pivot[ids[0]]["NIR"] and out[ids[0]]["VV"] == batch_pivot[ids[0]]["VV"]
    # later arrivals move the watermark past the incomplete patch: it is
    # emitted with its missing bands and its state is dropped
    time.sleep(2.5)
    others = TB.band_tiles(spark, SF001).filter(~F.col("patch_id").isin(ids)).limit(1)
    others.write.mode("append").parquet(src)
    q1.processAllAvailable()
    time.sleep(0.5)
    q1.processAllAvailable()
    out = {r["patch_id"]: r for r in spark.sql("select * from asm").collect()}
    assert out[ids[2]]["missing_bands"] == ["B08", "reference_map"] and out[ids[2]]["NIR"] is None
    q1.stop()


def test_score_stream_matches_batch(spark, tmp_path):
    meta = train_test_meta(spark, SF001).select("patch_id", "split")
    tiles = TB.band_tiles(spark, SF001)
    fitted = MO.fit(MO.build_pipeline(PixelExtractor().with_tiles(tiles), seed=5, num_trees=3, max_depth=3),
                    meta.filter("split = 'train'"))
    src = str(tmp_path / "tiles")
    test_ids = [r[0] for r in meta.filter("split = 'test'").collect()]
    tiles.filter(F.col("patch_id").isin(test_ids)).write.parquet(src)
    out = str(tmp_path / "scored")
    q = SC.score_stream(spark, src, SC.scoring_model(fitted), meta, out, str(tmp_path / "ck"))
    q.awaitTermination(120)
    streamed = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    batch = sorted(tuple(r) for r in MO.predict(fitted, meta.filter("split = 'test'")).collect())
    assert len(streamed) > 0 and streamed == batch
