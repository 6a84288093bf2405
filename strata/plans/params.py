"""Parameters shared by the Spark queries and their DuckDB oracles."""

# Panel: a venue is steady when it has more than this many works in every year.
STEADY_THRESHOLD = 49

# Tags: a line item counts as a tag when its discount is at least this.
TAG_MIN_DISCOUNT = 0.1

# Items eligible for recommendations: more than this many ratings.
ELIGIBLE_MIN_RATINGS = 30

# Most-rated titles: report size.
TOP_TITLES = 20

# Filter/sort query: keys above this.
FILTER_MIN_KEY = 50

# PageRank: iterations and reset probability of the reference.
PAGERANK_ITERATIONS = 5
PAGERANK_RESET = 0.15

# ALS: the reference's iterations and regularisation, our seed and split.
ALS_MAX_ITER = 5
ALS_REG_PARAM = 0.01
ALS_SEED = 42
ALS_TRAIN_PERCENT = 80
ALS_TOP_K = 3

# ALS whose systems are small enough to be solved in SQL text, too: two factors, and
# a start that SQL can state, (1, (id * ALS_START % 1000) / 1000).
ALS_SQL_ITERATIONS = 3
ALS_START = 7919

# Word counts.
STOP_WORDS = ("the",)
WORD_SEPARATORS = (" ", ",", ".", ";", ":", "!", "?")

# Language model: of so many documents all but one are used for training.
LANGUAGE_FOLDS = 2

# Published table: rows above this size stay. Bytes of a piece of a long text.
PUBLISH_MIN_SIZE = 10
PIECE_BYTES = 1 << 20

# The stored base of the merge in place: partitions and buckets.
STORE_PARTS = 8
STORE_BUCKETS = 4
