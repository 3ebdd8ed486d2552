"""Fixed values that results depend on. Functions take them as defaults."""

LINE = "11"
DEFAULT_SPEED_MPS = 5.5
MIN_SPEED_MPS = 1.0
MIN_MOVE_M = 5.0
ARRIVAL_RADIUS_M = 150.0
LABEL_WINDOW_S = 300
SCHEDULE_HORIZON_S = 7200
PREDICTION_AGE_S = 600
EARLY_S = -60
ON_TIME_S = 60
DELAYED_S = 300
TRAIN_MAX_DISTANCE_M = 500.0
TRAIN_MAX_DELAY_S = 900
DAY_S = 86400

# Sizes of the physical plan, not of the results.
BROADCAST_ROWS = 1_000_000   # a dimension above this joins by salted shuffle
SALTS = 32                   # copies of a shuffled dimension
SEGMENT_S = 21_600           # longest stretch of one vehicle held by one task
ASOF_BUCKET_S = 900          # width of the time bucket in the schedule join key
GRID_LEVELS = (16, 10)       # 2**level grid columns around the globe, fine to coarse
