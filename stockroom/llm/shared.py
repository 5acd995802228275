"""Small helpers of the operators: reading tables, shared intermediate tables, exact samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.session import write_table

from .tokens import blob, text_parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back (a lineage cut that
    survives lost executors)."""
    return write_table(df, f"llm-{name}")


def hash_order(col: str, salt: str):
    """A fixed pseudo-random order of the values of a column."""
    return F.xxhash64(F.lit(salt), F.col(col))


def map_texts(docs: DataFrame, keys: list[str], fn, columns: str, *, limit: int = 2 << 20,
              text: str = "text") -> DataFrame:
    """Run ``fn`` over the texts of ``docs`` in Arrow batches, on the tasks where they are.

    ``fn(list of bytes) -> (rows, {column: values})`` gets at most ``limit`` bytes of text (one
    text at least; null is empty). ``rows`` gives the index of the text of each output row, None
    for one row per text in order. ``keys`` are carried over untouched, nulls and all.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(columns)
    inner = docs.select(*keys, F.col(text).cast("binary").alias("__text"))
    schema = StructType([f for f in inner.schema.fields if f.name != "__text"] + added.fields)
    arrow = to_arrow_schema(schema)
    names = [f.name for f in added.fields]

    def run(batches):
        for batch in batches:
            for i, j, held in text_parts(batch.column(batch.num_columns - 1), limit):
                rows, out = fn([blob(x) for x in held])
                carried = [batch.column(k).slice(i, j - i) for k in range(len(keys))]
                if rows is not None:
                    at = pa.array(rows, pa.int64())
                    carried = [c.take(at) for c in carried]
                made = [pa.array(out[n], arrow.field(n).type) for n in names]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(carried, arrow)] + made, schema=arrow)

    return inner.mapInArrow(run, schema)


def replace_texts(docs: DataFrame, fn, *, limit: int = 2 << 20) -> DataFrame:
    """``docs`` with new texts, and without the rows ``fn`` leaves out; all columns as they were.

    ``fn(list of bytes) -> (rows, new texts)``: index and new text of each row that stays (bytes or
    str). A null text that stays is null."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    at_text = docs.columns.index("text")
    arrow = to_arrow_schema(docs.schema)
    # the text travels as bytes in its own place; all columns are told apart by position, not name
    inner = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))]).withColumn(f"c{at_text}", F.col(f"c{at_text}").cast("binary"))

    def run(batches):
        for batch in batches:
            for i, _, held in text_parts(batch.column(at_text), limit):
                rows, new = fn([blob(x) for x in held])
                at = pa.array([int(r) + i for r in rows], pa.int64())
                columns = [c.take(at).cast(f.type) if k != at_text else None for k, (c, f) in enumerate(zip(batch.columns, arrow))]
                columns[at_text] = pa.array(
                    [None if held[r] is None else t if isinstance(t, str) else t.decode("utf-8", "replace") for r, t in zip(rows, new)],
                    arrow.field(at_text).type)
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return inner.mapInArrow(run, docs.schema)
