"""Row identity: a number that tells the rows of a table apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import pin

#: Name of the added column; unlikely to clash with columns of a table.
REF = "_row_ref"


def with_ref(docs: DataFrame) -> DataFrame:
    """``docs`` with a long ``REF`` that differs between rows: ``doc_id`` itself, if it does that.

    Else the rows are written once with a number each, as a number made
    on the fly may change when a lost task runs again.
    """
    if docs.schema["doc_id"].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        doubtful = docs.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL")
        if doubtful.isEmpty():
            return docs.withColumn(REF, F.col("doc_id").cast("long"))
    return pin(docs.withColumn(REF, F.monotonically_increasing_id()))
