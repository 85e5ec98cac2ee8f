import pytest
from pyspark.sql import types as T

from hirelattice.llm.common import let_workers_import

#: Names that operators use for their own columns, as columns of the input.
CLASHING = ["piece", "length", "id", "n", "t", "component", "h1", "line", "rank", "weight", "at", "key", "row",
            "lines", "gone", "place", "chosen", "first", "stream", "slot", "block", "size", "start", "bucket", "_t", "_key"]


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    let_workers_import(spark)


def schema(**kinds):
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


DOCUMENT = schema(
    doc_id=T.LongType(), text=T.StringType(), lang=T.StringType(), source=T.StringType(), n_chars=T.LongType(),
)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows of (doc_id, text[, lang[, source]]) -> documents, with columns whose names clash."""

    def build(rows, clash=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, DOCUMENT).repartition(3)
        if clash:
            for name in CLASHING:
                frame = frame.selectExpr("*", f"'clash' AS {name}")
        return frame

    return build


def table(spark, name, folder="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{folder}/{name}.parquet")
