"""Fixtures of the operators' tests; ``spark`` comes from the parent folder."""

import pytest
from pyspark.sql import Row

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text, lang, source) tuples."""

    def make(rows, partitions=3):
        full = [Row(d, t, la, s, None if t is None else len(t)) for d, t, la, s in rows]
        return spark.createDataFrame(full, DOC_SCHEMA).repartition(partitions)

    return make


@pytest.fixture()
def tables(spark, tmp_path):
    """Write frames as a folder of tables, as the queries read them."""

    def write(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
