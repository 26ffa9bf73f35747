"""Schemas of the data model and the fixed land-cover code tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — everything down to the closing rule must stay exactly as
# written for results to match: the land-cover label dictionary, band
# names, file-name and path patterns, product directories, run-log formats.
#
# Land-cover codes in dictionary order, with their sparse id (1..44, and 99
# for "Unlabeled") and their description. The dense id of a code is its
# position in this list (0..44).
# ---------------------------------------------------------------------------
LABEL_DICTIONARY: list[tuple[int, int, str]] = [
    (111, 1, "Continuous urban fabric"),
    (112, 2, "Discontinuous urban fabric"),
    (121, 3, "Industrial or commercial units"),
    (122, 4, "Road and rail networks and associated land"),
    (123, 5, "Port areas"),
    (124, 6, "Airports"),
    (131, 7, "Mineral extraction sites"),
    (132, 8, "Dump sites"),
    (133, 9, "Construction sites"),
    (141, 10, "Green urban areas"),
    (142, 11, "Sport and leisure facilities"),
    (211, 12, "Non-irrigated arable land"),
    (212, 13, "Permanently irrigated land"),
    (213, 14, "Rice fields"),
    (221, 15, "Vineyards"),
    (222, 16, "Fruit trees and berry plantations"),
    (223, 17, "Olive groves"),
    (231, 18, "Pastures"),
    (241, 19, "Annual crops associated with permanent crops"),
    (242, 20, "Complex cultivation patterns"),
    (243, 21, "Land principally occupied by agriculture with significant areas of natural vegetation"),
    (244, 22, "Agro-forestry areas"),
    (311, 23, "Broad-leaved forest"),
    (312, 24, "Coniferous forest"),
    (313, 25, "Mixed forest"),
    (321, 26, "Natural grassland"),
    (322, 27, "Moors and heathland"),
    (323, 28, "Sclerophyllous vegetation"),
    (324, 29, "Transitional woodland/shrub"),
    (331, 30, "Beaches dunes  sands"),
    (332, 31, "Bare rock"),
    (333, 32, "Sparsely vegetated areas"),
    (334, 33, "Burnt areas"),
    (335, 34, "Glaciers and perpetual snow"),
    (411, 35, "Inland marshes"),
    (412, 36, "Peatbogs"),
    (421, 37, "Salt marshes"),
    (422, 38, "Salines"),
    (423, 39, "Intertidal flats"),
    (511, 40, "Water courses"),
    (512, 41, "Water bodies"),
    (521, 42, "Coastal lagoons"),
    (522, 43, "Estuaries"),
    (523, 44, "Sea and ocean"),
    (999, 99, "Unlabeled"),
]

# Sentinel-1 polarisations and the Sentinel-2 bands the classifier reads,
# with the short names the pixel table uses. Channel order of a stacked
# image is S1 first, then S2: VV, VH, B02, B03, B04, B08.
S1_BANDS = ["VV", "VH"]
S2_BANDS = ["B02", "B03", "B04", "B08"]
S2_SHORT = {"B02": "B", "B03": "G", "B04": "R", "B08": "NIR"}
LABEL_BAND = "reference_map"
# All twelve Sentinel-2 L2A band files of a patch directory.
S2_ALL_BANDS = ["B01", "B02", "B03", "B04", "B05", "B06", "B07", "B08", "B8A",
                "B09", "B11", "B12"]
# Regex a listed S2 file must match to be read (B02, B03, B04, B08).
S2_BAND_FILE_REGEX = r"_B0[2348]\.tif$"
SCHEME = "s3://"
# Patch id -> tile id (drop "_row_col"); S1 name -> scene id (drop
# "_TILE_row_col"); directory ".../X/" -> band file ".../X/X_<band>.tif".
TILE_ID_REGEX = r"(.*)_[0-9]+_[0-9]+$"
SCENE_ID_REGEX = r"(.*)_[A-Z0-9]+_[0-9]+_[0-9]+$"
LAST_DIR_REGEX = r"([^/]+)/$"
BAND_FILE_TEMPLATE = "$1/$1_{band}.tif"
# Product directories under the dataset root.
S1_PRODUCT_DIR = "BigEarthNet-S1/"
S2_PRODUCT_DIR = "BigEarthNet-S2/"
LABEL_PRODUCT_DIR = "Reference_Maps/"
# Run-log line formats (stage timing, split counts, accuracy); HH:MM:SS
# with truncated seconds.
RUNTIME_LINE = r"^Runtime of task (.+): ([0-9]+):([0-9]{2}):([0-9]{2})$"
COUNT_LINE = r"^Number of rows in (train|test) split: ([0-9]+)$"
ACCURACY_LINE = r"^Evaluation done: Accuracy: ([0-9.eE+-]+)$"
# Training-image side length after resizing.
RESIZE_TARGET = 128
# ---------------------------------------------------------------------------

CODES = [c for c, _, _ in LABEL_DICTIONARY]
SPARSE_IDS = {c: s for c, s, _ in LABEL_DICTIONARY}
DENSE_IDS = {c: i for i, c in enumerate(CODES)}
IMAGE_CHANNELS = S1_BANDS + S2_BANDS
PIXEL_BAND_COLUMNS = ["VV", "VH", "B", "G", "R", "NIR"]
INDEX_COLUMNS = ["NDVI", "EVI", "NDWI", "BVI", "RRadio", "RDiff", "RSum", "RVI"]
FEATURE_COLUMNS = PIXEL_BAND_COLUMNS + INDEX_COLUMNS

# FX1 full patch metadata
METADATA = T.StructType([
    T.StructField("patch_id", T.StringType()),
    T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("split", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("s1_name", T.StringType()),
    T.StructField("s2v1_name", T.StringType()),
    T.StructField("contains_seasonal_snow", T.BooleanType()),
    T.StructField("contains_cloud_or_shadow", T.BooleanType()),
    T.StructField("patch_id_path", T.StringType()),
    T.StructField("patch_id_path_s1", T.StringType()),
    T.StructField("s1_path", T.StringType()),
    T.StructField("s2_path", T.StringType()),
    T.StructField("label_path", T.StringType()),
])

# FX2 pruned read schemas
METADATA_M1 = T.StructType([METADATA[c] for c in ("split", "s1_path", "s2_path", "label_path")])
METADATA_M2 = T.StructType([METADATA[c] for c in
                            ("patch_id", "split", "labels", "s1_path", "s2_path", "label_path")])

# FX3 label dictionary as stored in CSV
LABEL_DICT_CSV = T.StructType([
    T.StructField("ID", T.IntegerType()),
    T.StructField("ID_NEW", T.IntegerType()),
    T.StructField("DESC", T.StringType()),
])

# FX4 band tile, long form
BAND_TILE = T.StructType([
    T.StructField("patch_id", T.StringType()),
    T.StructField("band", T.StringType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("dtype", T.StringType()),
    T.StructField("pixels", T.ArrayType(T.DoubleType())),
])

# FX5 patch pixel arrays
PIXEL_ARRAYS = T.StructType([
    T.StructField("VH", T.ArrayType(T.DoubleType())),
    T.StructField("VV", T.ArrayType(T.DoubleType())),
    T.StructField("B", T.ArrayType(T.LongType())),
    T.StructField("G", T.ArrayType(T.LongType())),
    T.StructField("R", T.ArrayType(T.LongType())),
    T.StructField("NIR", T.ArrayType(T.LongType())),
    T.StructField("label", T.ArrayType(T.LongType())),
])

# FX9 run metrics
STAGE_TIMING = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("task", T.StringType()),
    T.StructField("started", T.StringType()),
    T.StructField("finished", T.StringType()),
    T.StructField("seconds", T.LongType()),
])
EPOCH_HISTORY = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("epoch", T.IntegerType()),
    T.StructField("loss", T.DoubleType()),
    T.StructField("iou_score", T.DoubleType()),
    T.StructField("val_loss", T.DoubleType()),
    T.StructField("val_iou_score", T.DoubleType()),
    T.StructField("epoch_duration", T.DoubleType()),
])
