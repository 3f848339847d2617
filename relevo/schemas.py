"""Table schemas of the search-relevance data model.

One name per key (``product_uid``) instead of the numbered aliases scripts use to dodge ambiguous
join columns. Ids are ``LongType`` because the driver tables are BIGINT; the label is ``DoubleType``
everywhere (an integer label silently drops fractional rows under DROPMALFORMED).
"""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

ID = "id"
PRODUCT = "product_uid"
TITLE = "product_title"
TERM = "search_term"
LABEL = "relevance"
DESCRIPTION = "product_description"
ATTR_NAME = "name"
ATTR_VALUE = "value"

# Default text for a product without a description or attributes (kept for parity: it is a real
# word afterwards and takes part in hit counts and embeddings).
MISSING_TEXT = "empty"

TRAIN = StructType([
    StructField(ID, LongType(), True),
    StructField(PRODUCT, LongType(), True),
    StructField(TITLE, StringType(), True),
    StructField(TERM, StringType(), True),
    StructField(LABEL, DoubleType(), True),
])

TEST = StructType([f for f in TRAIN.fields if f.name != LABEL])

# Integer-label variant used by the classifier pages.
TRAIN_INT_LABEL = StructType([
    *[f for f in TRAIN.fields if f.name != LABEL],
    StructField(LABEL, IntegerType(), True),
])

ATTRIBUTES = StructType([
    StructField(PRODUCT, LongType(), True),
    StructField(ATTR_NAME, StringType(), True),
    StructField(ATTR_VALUE, StringType(), True),
])

DESCRIPTIONS = StructType([
    StructField(PRODUCT, LongType(), True),
    StructField(DESCRIPTION, StringType(), True),
])

SUBMISSION = StructType([
    StructField(ID, LongType(), True),
    StructField(LABEL, DoubleType(), True),
])

# Positional names of the headerless, all-string reads, which the join's result keeps.
STAGE1_TRAIN_NAMES = ["id", "prod_uid", "title", "search", "rel"]
STAGE1_TEST_NAMES = ["id", "prod_uid", "title", "search"]
STAGE1_DESC_NAMES = ["prod_id", "desc"]
STAGE1_OUTPUT = ["prod_uid", "title", "search", "rel", "desc"]
