"""What the operators share: table access, byte texts from Arrow batches, the shared
checkpoint folder, and size-checked broadcasts."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.session import ensure_checkpoint_dir

SLICE_ROWS = 128


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder, with its lineage cut.

    The folder survives a lost executor, unlike cached or locally checkpointed blocks.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_enough(df: DataFrame, row_bytes: int, limit: int) -> bool:
    """Whether all rows of the checkpointed ``df`` at ``row_bytes`` each stay within ``limit`` bytes."""
    return df.count() * row_bytes <= limit


def hinted(df: DataFrame, row_bytes: int, limit: int = 32 << 20) -> DataFrame:
    """``df`` marked for a broadcast join if its counted size is within ``limit``, else unchanged:
    beyond it Spark shuffles both sides, and splits skewed partitions."""
    return F.broadcast(df) if small_enough(df, row_bytes, limit) else df


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut to a few rows each, so that Python copies only a few texts at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def byte_texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes, null as empty."""
    return [t or b"" for t in batch.column(name).cast(pa.large_binary()).to_pylist()]


def str_texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as strings, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def byte_class(accept: bytes | set[int]) -> np.ndarray:
    """A 256-entry table that is True for the given byte values."""
    table = np.zeros(256, dtype=bool)
    table[list(accept)] = True
    return table


#: Bytes of ``[^\x20\x09-\x0D]``: all but ASCII white space.
NOT_SPACE = ~byte_class(b" \t\n\x0b\x0c\r")


def word_bounds(raw: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes."""
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = word_byte[raw]
    edges = np.flatnonzero(np.diff(inside))
    return edges[0::2], edges[1::2]

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def lower_ascii(text: bytes) -> bytes:
    return text.translate(_LOWER)


def word_pieces(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a whole text, in lists from pieces of about ``size``
    bytes that end at white space, so a very long text is never split into words all at once."""
    lo, n = 0, len(text)
    while lo < n:
        hi = min(n, lo + size)
        while hi < n and text[hi] not in b" \t\n\x0b\x0c\r":
            hi += 1
        yield text[lo:hi].split()
        lo = hi


#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` once A-Z are lower-cased.
WORD_BYTE = ~byte_class(set(range(0x30)) | set(range(0x3A, 0x61)) | set(range(0x7B, 0x80)))
#: Lower-cases A-Z and makes a space of every byte that is in no word.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else (b if WORD_BYTE[b] else 32) for b in range(256))


def to_words(text: bytes) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased."""
    return text.translate(TO_WORDS).split()


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the executors' Python once per application, so that their workers
    can import it wherever the driver's code lies."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    import quarry

    root = Path(quarry.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="quarry-code-")) / "quarry.zip"  # served by the driver
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


#: Bytes of an Arrow batch that Spark sends to Python, unless the session sets its own limit.
BATCH_BYTES = 4 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
_libc = ctypes.CDLL(None)


def give_back() -> None:
    """Returns a Python worker's free memory to the machine: workers outlive their tasks, and
    would keep it while the workers of the next stage fill up."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def to_python(spark: SparkSession) -> None:
    """What a session needs before rows go to Python: this package, and batches bounded by bytes,
    as Spark's own bound is a number of rows of any size."""
    ship_code(spark)
    if spark.conf.get(_LIMIT, None) is None:
        spark.conf.set(_LIMIT, str(BATCH_BYTES))


def map_arrow(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the executors, in batches of bounded size;
    a Python worker gives unused memory back after each task."""
    to_python(df.sparkSession)

    def task(batches):
        yield from run(batches)
        give_back()

    return df.mapInArrow(task, schema)


def column_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table in the shared folder, and its path. For large intermediate rows:
    compressed and columnar, unlike a checkpoint, and gone with :func:`drop_written`."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_written(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
