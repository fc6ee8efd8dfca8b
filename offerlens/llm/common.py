"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
#: Rows, and bytes of the column read, handled at once inside a Python task (a longer value is handled alone).
SLICE = 1024
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of an installed public vocabulary file (each executor resolves its own)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns that an operator is about to add: its own output wins over a name clash."""
    low = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def null_free(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def slices(batch, source: str) -> Iterator:
    """An Arrow batch in slices of at most ``SLICE`` rows and ``SLICE_BYTES`` bytes of the column ``source``."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    col = batch.column(source)
    lists = pa.types.is_list(col.type)
    size = pc.list_value_length(col) if lists else pc.binary_length(col)
    ends = np.cumsum(pc.fill_null(size, 0).to_numpy(zero_copy_only=False).astype(np.int64) * (4 if lists else 1))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = min(max(int(np.searchsorted(ends, before + SLICE_BYTES, "right")), at + 1), at + SLICE, batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def add_columns(df: DataFrame, fields: StructType, source: str, fn: Callable[[list], list[list]]) -> DataFrame:
    """``df`` with the columns ``fields``: ``fn`` maps a list of values of the string column ``source`` to one
    list or Arrow array per field.  Rows travel as Arrow batches and are handled in ``slices``."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    base = without(df, fields.fieldNames())
    kinds = [f.type for f in to_arrow_schema(fields)]
    names = base.columns + fields.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, source):
                new = fn(b.column(source).to_pylist())
                arrays = [v if isinstance(v, pa.Array) else pa.array(v, k) for v, k in zip(new, kinds)]
                yield pa.RecordBatch.from_arrays([*b.columns, *arrays], names=names)

    return base.mapInArrow(run, StructType(base.schema.fields + fields.fields))


class Scratch:
    """Tables that an operator writes to the shared folder and gives back when they are no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        from ..session import scratch_path
        self.spark, self.root, self.n = spark, scratch_path(spark, name), 0

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written and read back: computed once, its lineage cut."""
        self.n += 1
        path = f"{self.root}/{self.n:03d}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch = path
        return back

    def drop(self, *tables: DataFrame | str) -> None:
        """Delete kept tables or folders; the shuffle files of plans that nothing refers to any more go with them."""
        import gc
        jvm = self.spark._jvm
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t if isinstance(t, str) else t._scratch)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        self.spark.range(1).count()     # Spark's listeners refer to the last query's plan until the next one ends
        jvm.System.gc()
