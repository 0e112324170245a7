"""Record layouts and the settings that every result depends on."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire layout, batch layout, batching and model settings.
WIRE_FIELD_COUNT = 24
WIRE_POSITIONS = {
    "App": 0,
    "Category": 2,
    "Rating": 3,
    "Reviews": 4,
    "Size": 11,
    "Installs": 5,
    "Type": 8,
    "Price": 9,
    "Content Rating": 18,
    "Last Updated": 17,
    "Android Ver": 12,
}
FEATURES = ["Rating", "Reviews", "Size", "Installs", "Price"]
ITEM_COLUMN = "Category"
UNKNOWN_ITEM = "Unknown"
BATCH_SIZE = 100_000
PER_TRIGGER = 1_000_000
FIT_ROWS = 1 << 15
FIT_DIGITS = 9
MINIMUM_BATCHES = 3
PREVIEW_LENGTH = 100
CLUSTERS = 10
SEED = 1
COMPONENTS = 3
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.5
SNAPSHOTS = ["model1", "model2", "model3"]
CLUSTER_PREFIX = "kmeans_"
PROJECTION_PREFIX = "pca_"
ITEMSET_PREFIX = "fpgrowth_results_"

BATCH_COLUMNS = list(WIRE_POSITIONS)

WIRE_SCHEMA = T.StructType(
    [T.StructField(f"c{i}", T.StringType()) for i in range(WIRE_FIELD_COUNT)]
)
BATCH_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in BATCH_COLUMNS])
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Doubled quotes and newlines inside quotes, as Python's csv module writes them.
CSV_READ_OPTIONS = {"header": True, "escape": '"', "multiLine": True}
CSV_RECORD_OPTIONS = {"escape": '"'}
CSV_WRITE_OPTIONS = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
