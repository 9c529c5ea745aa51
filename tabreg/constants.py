"""These must equal the reference's for the same results.

They are stated here plainly and together; the modules import them.
"""

# Canonical column names of the nine-column table, in order.
CALIFORNIA_COLUMNS = [
    "longitude", "latitude", "housing_median_age", "total_rooms",
    "total_bedrooms", "population", "households", "median_income",
    "median_house_value",
]

# Scaler fallbacks. A std (or a min-max range) at or below this
# counts as zero: std -> 1.0, min-max -> 0.5 in every cell.
SCALE_EPS = 1e-8

# Data split and batching.
TRAIN_FRACTION = 0.8          # first floor(0.8 n) rows train, rest test
VAL_FRACTION = 0.2            # validation share of the training rows
BATCHES_PER_EPOCH = 10        # default batch size ceil(n / 10)
MIN_BATCH_PYTHON = 16         # the Python trainer uses max(16, ceil(n / 10))

# Training defaults of the two entry points.
RUST_EPOCHS, RUST_LR = 1, 0.01
PYTHON_EPOCHS, PYTHON_LR, PYTHON_PATIENCE, PYTHON_MIN_DELTA = 200, 1e-3, 20, 0.0

# Optimizer and schedule constants.
ADAM_BETAS, ADAM_EPS = (0.9, 0.999), 1e-8
PLATEAU_FACTOR, PLATEAU_PATIENCE, PLATEAU_THRESHOLD = 0.5, 5, 1e-4

# The reference's sweep settings (epochs, lr, patience, label).
REFERENCE_GRID = [
    (200, 0.001, 20, "Baseline (current settings)"),
    (200, 0.01, 20, "Higher LR (10x)"),
    (300, 0.0005, 30, "Lower LR, more epochs"),
    (150, 0.005, 15, "Medium LR, shorter patience"),
]

# Metrics and grading.
MAPE_FLOOR = 1e-8
# grade on MAE as % of target std: < 30 Excellent, < 50 Good, < 70 Acceptable, else Poor
GRADE_BANDS = [(30.0, "Excellent"), (50.0, "Good"), (70.0, "Acceptable")]
# MAE of the 8-64-32-1 network on a standardized target: < 0.5 good, <= 0.8 acceptable, else poor
MAE_BANDS = [(0.5, "good"), (0.8, "acceptable")]

# History thinning keeps every 20th epoch and the last one.
THIN_EVERY = 20

# The network of both entry points.
NETWORK_SIZES = (8, 64, 32, 1)
