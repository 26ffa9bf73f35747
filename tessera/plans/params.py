"""Parameters of the registered queries, shared by the Spark plans and the
SQL oracles so both sides compute the same thing. Chosen once, up front."""

SEED = 42
SPLITS = ("train", "test")
# Stratified Bernoulli sample: fraction per split (absent split -> 0).
SAMPLE_FRACTIONS = {"train": 0.3, "test": 0.5}
# Exact-size sample: n = round_half_even(fraction * N) per split.
EXACT_FRACTION = 0.25
# Deterministic top-k rows by patch id (the row-limit operator).
LIMIT_K = 10
# Training-set preparation: workers (shards), repeats, batch size.
N_SHARDS = 4
N_REPEATS = 2
BATCH_SIZE = 8
# Resize of the 8x8 testbed tiles.
RESIZE_OUT = 12
# IoU smoothing.
SMOOTH = 1e-5
# Bucket count of the distributed global index (hash / time buckets).
INDEX_BUCKETS = 1024
# Class left out of the second soft metric.
SOFT_IGNORE = 9
# Forest whose label the features determine: thresholds of the red band, the
# accuracy it must reach, and the one that scrambled labels must not reach.
RED_STEPS = (1920, 2080)
FOREST_BOUND = 0.9
SCRAMBLED_BOUND = 0.6
FOREST_LAYOUT = 8
# Pushed filter on a given table, and the run that others are compared with.
ORDER_STATUS = ("F", "O")
BASELINE_RUN = "click"
