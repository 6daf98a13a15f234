"""Explicit table schemas; no reader infers types. The column names."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), True) for n in names]


LABEL_COLUMNS = ("intent", "kategori", "location", "object", "urgency", "sentiment", "summary")

RAW_COMPLAINT = T.StructType(_strings("id", "judul", "isi", "kategori", "url"))
CLEAN_COMPLAINT = T.StructType(_strings("id", "judul", "isi", "kategori", "input_text"))
ANNOTATED_COMPLAINT = T.StructType(
    _strings("id", "judul", "isi", "kategori", "input_text")
    + _strings(*[c for c in LABEL_COLUMNS if c != "kategori"])
)
URGENCY_COMPLAINT = T.StructType(
    _strings("id", "judul", "isi", "kategori", "input_text", "urgency")
)
PAGE_FIELDS = RAW_COMPLAINT
VECTOR_ROW = T.StructType(
    _strings("complaint_id", "text", "category")
    + [T.StructField("embedding", T.ArrayType(T.FloatType()), True)]
)
