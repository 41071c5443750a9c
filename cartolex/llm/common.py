"""What the operators of this package share: scratch tables, byte blocks of Arrow text, tree sums.

Every helper is safe to run again on another executor: outputs depend on row contents alone, never on
where or when a task runs.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text is handed to NumPy in blocks of about so many bytes, so that a task's memory does not follow its partition.
BLOCK_BYTES = 1 << 20
_local_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only a local master may go without it."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if where:
        return where
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local_dir:
        _local_dir.append(tempfile.mkdtemp(prefix="cartolex-"))
    return f"file://{_local_dir[0]}"


def cut(df: DataFrame, tag: str) -> DataFrame:
    """df written as a table in the shared folder and read back: its lineage ends there, and executors may be lost."""
    path = f"{shared_dir(df.sparkSession)}/cartolex-{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cartolex_path = path
    return out


def drop(df: DataFrame) -> None:
    """Remove a table that cut() wrote, once nothing reads it any more."""
    path = getattr(df, "_cartolex_path", None)
    if path:
        jvm, spark = df.sparkSession._jvm, df.sparkSession
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


#: Rows of an Arrow batch; a batch is held by the JVM and by the Python worker at once.
BATCH_ROWS = 2000


def bounded(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS, since documents are long rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input; reading one also calls bounded()."""
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the bytes of df, which costs no job; where it has none (rows of no table), 4 KB a row."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 4096 * df.count()


def parts_for(df: DataFrame, each_mb: int = 32, least: int = 1) -> int:
    return max(least, -(-plan_bytes(df) // (each_mb << 20)))


def id_remainder(doc_id: object, by: int) -> int:
    """crc32 of the id as text, modulo by; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % by


def crc_mod(col: str, by: int):
    """The same rule as a column."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(by))


def fill(column) -> pa.Array:
    """An Arrow text column as one array without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about limit bytes of text (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        c = b.column(b.schema.get_field_index(text))
        ends = np.cumsum(pc.binary_length(c).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield b.slice(at, to - at)
            at = to


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large_string array, end to end, and the n+1 offsets of its rows."""
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, off - off[0]


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that do not cross a row: starts, ends (exclusive) and rows."""
    n = len(inside)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.concatenate([[False], inside[:-1]])
    start = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.concatenate([inside[1:], [False]])
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


#: Polynomials are taken modulo this prime (a Mersenne prime: the remainder is two shifts away), at two points at once.
PRIME = (1 << 31) - 1
POINTS = ((1_234_567_891, 1_998_244_353), (1_618_033_989, 1_414_213_563))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _fold(x: np.ndarray) -> np.ndarray:
    """A number of up to 32 bits that is x modulo PRIME."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    return (x & np.uint64(PRIME)) + (x >> np.uint64(31))


def _cumulated(q: int, size: int) -> np.ndarray:
    """1, q, q**2, ... modulo PRIME, by doubling."""
    x = np.ones(1, np.uint64)
    while len(x) < size:
        x = np.concatenate([x, _fold(x * np.uint64(pow(q, len(x), PRIME)))])
    return x[:size]


def _power(q: int, n: int, least: int = BLOCK_BYTES + 65536) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(q)
    if have is None or len(have[0]) < n:
        size = max(n + n // 4, least)
        have = _cumulated(q, size), _cumulated(pow(q, -1, PRIME), size)
        if size <= 4 * BLOCK_BYTES:
            _powers[q] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0, least: int = BLOCK_BYTES + 65536) -> np.ndarray:
    """64-bit hashes of data[start:end]: two polynomials modulo a prime, from prefix sums, scrambled with the length.
    least: powers that are computed at once and kept, 32 bytes each, if data is no longer; the hashes are the same.

    They depend on the contents alone. Strings of equal length that differ agree by chance only (about 2**-62); strings
    that agree under every polynomial modulo a power of two, as Thue-Morse strings do, differ here.
    """
    if not len(start):
        return np.zeros(0, np.uint64)
    lanes = []
    for q in POINTS[which]:
        up, down = _power(q, len(data) + 1, least)
        x = (data.astype(np.uint64) + np.uint64(1)) * up[: len(data)]
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((x & np.uint64(PRIME)) + (x >> np.uint64(31)), out=total[1:])
        x = _fold(_fold(total[end] - total[start]) * down[start])
        lanes.append(np.where(x >= PRIME, x - np.uint64(PRIME), x))
    with np.errstate(over="ignore"):
        return mix((lanes[0] << np.uint64(31) | lanes[1]) + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hash(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of the k bytes (a multiple of 8) from each place on; words of 8 bytes are mixed one after another."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    body = np.ascontiguousarray(data)
    words = np.ndarray((len(data) - 7,), "<u8", body.data, 0, (1,))
    h = np.full(n, k, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, k, 8):
            h = (h ^ words[at : at + n]) * np.uint64(0x9FB21C651E98DF25)
            h ^= h >> np.uint64(32)
        h *= np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(29))


def hash_at(data: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the size bytes (8 or more) from some places on; a word of 8 bytes may overlap the last one."""
    if not len(start):
        return np.zeros(0, np.uint64)
    body = np.ascontiguousarray(data)
    words = np.ndarray((len(body) - 7,), "<u8", body.data, 0, (1,))
    h = np.full(len(start), size, np.uint64)
    with np.errstate(over="ignore"):
        for at in [*range(0, size - 8, 8), size - 8]:
            h = (h ^ words[start + at]) * np.uint64(0x9FB21C651E98DF25)
            h ^= h >> np.uint64(32)
    return mix(h)


def tree_sum(parts: DataFrame, dtype: str, fan: int = 32) -> np.ndarray | None:
    """The sum of the vectors in column v (bytes of dtype, all of one length) of (k long, v binary), or None without rows.

    At most fan vectors meet in one group; the driver gets one for each fan * fan partitions.
    """
    import pandas as pd

    def add(g: pd.DataFrame) -> pd.DataFrame:
        total = None
        for v in g["v"]:
            x = np.frombuffer(v, dtype)
            total = x.copy() if total is None else total + x
        return pd.DataFrame({"k": [int(g["k"].iloc[0]) // fan], "v": [total.tobytes()]})

    for _ in range(2):
        parts = parts.groupBy(F.expr(f"k div {fan}").alias("up")).applyInPandas(add, "k long, v binary")
    total = None
    for row in parts.collect():
        x = np.frombuffer(row["v"], dtype)
        total = x.copy() if total is None else total + x
    return total


def tidy() -> None:
    """Give memory back to the system: a Python worker lives on after its task, and others need it."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library; it keeps what it has


def task(run: Callable) -> Callable:
    """run, a function of Arrow batches for mapInArrow, followed by tidy()."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            tidy()

    return tidied


def per_partition(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None]) -> DataFrame:
    """(k, v): one vector of each partition of df, for tree_sum()."""

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        v = f(batches)
        if v is not None:
            yield pa.RecordBatch.from_pydict({"k": pa.array([TaskContext.get().partitionId()], pa.int64()), "v": pa.array([v.tobytes()], pa.binary())})

    return df.mapInArrow(run, "k long, v binary")
