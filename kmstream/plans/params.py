"""Parameters shared by the registered queries and their SQL oracles."""

# part: two numeric columns, unique key
PART_KEY = "p_partkey"
PART_COLS = ["p_size", "p_retailprice"]
PART_CATS = ["p_brand", "p_type"]

LLOYD_K = 4          # fixed-start Lloyd on part
LLOYD_ITERS = 20     # updates (the oracle chains this many CTEs; converged models no longer move)
RESTARTS = 10        # random starts per model
RESTART_TOL = 1e-6
PCA_M = 5            # components of encoded rows
VARIANCE_TARGETS = [0.5, 0.91, 0.9999]   # shares of the variance that components are chosen for
RECORD_K = 150       # explicit number of clusters of the record anomaly job
N_TOP = 100          # anomaly threshold: N-th largest distance

# embeddings: 64-dim float32 widened to double; centres = lowest vec_id rows
EMB_DIM = 64
EMB_K = 10

# events stream replay: one batch per UTC day, 1-D on `value`
STREAM_K = 2
STREAM_PARTS = 3      # micro-batches of a replay
STREAM_STARTS = [[10.0], [200.0]]
STREAM_WEIGHTS = [1.0, 1.0]
STREAM_HALF_LIFE = 5.0
STREAM_POINTS_DECAY = 0.999   # per-row decay for the "points" time unit
STREAM_N_TOP = 10
STREAM_ANOMALY_K = 2

# lineitem columns used for timing runs
LINEITEM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

SCALED_DIGITS = 6
RAW_DIGITS = 4
