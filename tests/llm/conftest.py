import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture
def rows(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names operators also use."""

    def make(pairs, schema="doc_id long, text string"):
        df = spark.createDataFrame(pairs, schema)
        return df.selectExpr("*", "1 as n", "'x' as kind", "'s' as source", "2 as start", "3L as h", "4 as rep", "true as kept")

    return make
