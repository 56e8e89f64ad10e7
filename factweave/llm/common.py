"""Session, table and hold-out helpers that the corpus operators share."""

from __future__ import annotations

import atexit
import ctypes
import re
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as character class bodies for Java and Python patterns.
ASCII_SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local session that has none gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="factweave-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(named)
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses; what is written there goes when the driver ends, if not before."""
    path = f"{shared_dir(spark)}/factweave/{label}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session has ended; the folder is then the cluster's to clean
        return


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cuts lineage: writes Parquet to the shared folder and reads it back. Rows survive the loss of executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[back] = path
    return back


_WRITTEN: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def release(*frames: DataFrame) -> None:
    """Deletes what materialise() wrote for these; nothing may read them afterwards."""
    for df in frames:
        _delete(df.sparkSession, _WRITTEN.pop(df))


#: Slots of the bitmap that says which rows a join could concern: 512 rows of 4 KB, 2 MB however many rows there are.
SLOTS = 1 << 24


def parted(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows whose id may be in `ids` (one column), rows whose id is surely not), told apart where they lie.

    A bitmap over hashes of the ids is broadcast, of SLOTS bits at most. Only the former rows need to move for a join by id.
    """
    slot = F.pmod(F.xxhash64(F.col(ids.columns[0]).cast("long")), F.lit(SLOTS))
    bits = ids.select(F.bitmap_bucket_number(slot).alias("bucket__"), F.bitmap_bit_position(slot).alias("bit__"))
    bits = bits.groupBy("bucket__").agg(F.bitmap_construct_agg("bit__").alias("bits__"))
    own = F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("long")), F.lit(SLOTS))
    marked = docs.withColumn("slot__", own).join(F.broadcast(materialise(bits, "bitmap")), F.bitmap_bucket_number("slot__") == F.col("bucket__"), "left")
    at = F.bitmap_bit_position("slot__")
    byte = F.ascii(F.decode(F.substring("bits__", F.floor(at / 8) + 1, F.lit(1)), "ISO-8859-1"))
    there = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return tuple(marked.where(there if way else ~there).select(*(F.col(f"`{c}`") for c in docs.columns)) for way in (True, False))


def remainder(id_column: Column, by: int) -> Column:
    """crc32 of the id's decimal text, modulo `by`; null ids count as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % by


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the operator's own names, so that clashing extra columns of the input don't matter."""
    return df.select(*(F.col(f"`{theirs}`").alias(ours) for ours, theirs in columns.items()))


def map_batches(df: DataFrame, schema: str, work: Callable[[], Callable[[pa.RecordBatch], dict | None]]) -> DataFrame:
    """mapInArrow. `work` runs once in each task and returns a function from a batch to columns (or None)."""
    from pyspark.sql.types import StructType, _parse_datatype_string

    with_types = _parse_datatype_string(schema)
    assert isinstance(with_types, StructType)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(with_types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = work()
        for whole in batches:
            for batch in shares(whole):
                if (got := one(batch)) is None:
                    continue
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) if not isinstance(got[f.name], pa.Array) else got[f.name].cast(f.type) for f in arrow], schema=arrow)
                del got
                trim()

    return df.mapInArrow(run, with_types)


def shares(batch: pa.RecordBatch, budget: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `budget` bytes, so that what is made from one stays small."""
    rows = max(1, batch.num_rows * budget // max(budget, batch.nbytes))
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def trim() -> None:
    """Hands freed memory back to the system: a worker process lives on while others on its machine need theirs."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC(0)


try:
    _LIBC = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _LIBC = None


def pieces(batch: pa.RecordBatch, budget: int = 2_000_000, column: str = "text") -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8) in runs of at most `budget` bytes or one text, so that arrays stay small. Null: empty."""
    held, first, size = [], 0, 0
    at = batch.schema.get_field_index(column)
    for k, value in enumerate(batch.column(at)):
        text = value.as_py()
        raw = b"" if text is None else text.encode()
        if held and size + len(raw) > budget:
            yield first, held
            held, first, size = [], k, 0
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held
