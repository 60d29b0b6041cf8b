"""Values that must equal the studied pipeline's for identical results.

Fixed values, in the order the pipeline uses them:
"""

SNAPSHOT_FLOOR = "2025-01-20"        # newest snapshot must be strictly after this date
SNAPSHOT_WEEKDAY = 4                 # snapshots are anchored on Friday (Spark weekday(): Monday = 0)
SNAPSHOT_LOOKBACK_DAYS = 5           # the Friday and the five days before it are candidates
NA_SENTINEL = "NA"                   # indicator text meaning "missing"
TWO_DIGIT_PIVOT_YEAR = 2069          # %y: 69..99 -> 1969..1999, 00..68 -> 2000..2068
SPINE_STEP_DAYS = 7                  # weekly spine; weeks start on Sunday
OUTLIER_K = 3.0                      # outlier when |y - median| > 3 * sample standard deviation
TRAIN_SHARE = 0.8                    # first round(0.8 * n) weeks are the training span
COLLINEAR_THRESHOLD = 0.8            # |Pearson r| above this is multicollinear
PCA_COMPONENTS = 4                   # components kept as regressors
PCA_VARIANCE_TARGET = 0.94           # cumulative explained variance behind that choice
SEASON = 52                          # seasonal period in weeks
ORDER_VALUES = (0, 1)                # each of p, d, q, P, D, Q ranges over these
CONFIDENCE_Z = 1.959963984540054     # two-sided 95 % normal quantile
