"""What the operators share: tables, shipping of worker code, blocks of text, and words as numbers."""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path, use_utc

# Rows of one Arrow batch; texts may be long, so the default of 10 000 is too many.
ARROW_ROWS = 500
# Bytes of text that one worker step looks at together; a longer text is a step of its own.
BLOCK_BYTES = 4 << 20


def ship(module: str) -> None:
    """Send functions of this module to workers by value, so that executors need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what an Arrow batch of texts can hold."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def kept(df: DataFrame, label: str, **options: str) -> DataFrame:
    """A table written to the shared folder and read again; cuts lineage for good."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of finished steps now.

    It does so once the driver's garbage collector has found the step's plan unused, which may be long after; between
    the steps of a long operator that would pile up on the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of an integer id as decimal text; null ids count as 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(0))


def hash_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About the first ``rows`` rows by a hash of ``key``, and never more.

    The hash is cut by the row count first, so that a task passes on its share and not ``rows`` rows.
    """
    share = min(1.0, 1.5 * rows / max(1, df.count()))
    held = df.withColumn("__hash", F.xxhash64(key)).where(F.pmod("__hash", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    return held.orderBy(F.pmod("__hash", F.lit(1 << 20)), "__hash").limit(rows).drop("__hash")


def shuffle_count(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def blocks(batches: Iterable[pa.RecordBatch], column: str, size: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """The same rows in tables of about ``size`` bytes in ``column``, in order."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        at = 0
        running = np.cumsum(lengths)
        while at < batch.num_rows:
            before = int(running[at - 1]) if at else 0
            upto = max(at + 1, int(np.searchsorted(running, before + size - total, side="right")))
            upto = min(upto, batch.num_rows)
            held.append(batch.slice(at, upto - at))
            total += int(running[upto - 1]) - before
            at = upto
            if total >= size or at < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, total = [], 0
    if held:
        yield pa.Table.from_batches(held)


def in_blocks(work: Callable[[pa.Table], pa.RecordBatch | None], column: str, size: int = BLOCK_BYTES):
    """A ``mapInArrow`` function from one on blocks."""

    def run(batches):
        for block in blocks(batches, column, size):
            out = work(block)
            if out is not None and out.num_rows:
                yield out

    return run


def text_codes(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each text starts (one more entry than texts). Null is empty."""
    values = [t or "" for t in texts.to_pylist()]
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    codes = np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


class Characters:
    """Facts on code points, looked up once for each that occurs."""

    def __init__(self) -> None:
        self.known = np.zeros(0x110000, bool)
        self.fold = np.arange(0x110000, dtype=np.uint32)
        self.word = np.zeros(0x110000, bool)
        self.letter = np.zeros(0x110000, bool)
        self.upper = np.zeros(0x110000, bool)
        self.digit = np.zeros(0x110000, bool)
        self.space = np.zeros(0x110000, bool)

    def learn(self, codes: np.ndarray) -> None:
        if not len(codes):
            return
        used = np.flatnonzero(np.bincount(codes))
        for c in used[~self.known[used]].tolist():
            char = chr(c)
            low = char.lower()
            self.fold[c] = ord(low) if len(low) == 1 else c
            self.word[c] = char.isalnum()
            self.letter[c] = char.isalpha()
            self.upper[c] = char.isupper()
            self.digit[c] = char.isdigit()
            self.space[c] = char.isspace()
            self.known[c] = True


_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def span_hash(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of small whole numbers, by sums of a polynomial."""
    n = len(symbols)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n)[:n], out=sums[1:])
        return mix((sums[end] - sums[begin]) * _powers(_BASE_INVERSE, n)[begin])


class Words:
    """Words of a block: runs of letters and digits, case folded, as 64-bit hashes with their places."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, chars: Characters) -> None:
        chars.learn(codes)
        n = len(codes)
        inside = chars.word[codes]
        first = np.zeros(n + 1, bool)
        first[starts] = True
        before = np.concatenate([[False], inside[:-1]]) if n else inside
        self.begin = np.flatnonzero(inside & (~before | first[:-1]))
        after = np.concatenate([inside[1:], [False]]) if n else inside
        self.end = np.flatnonzero(inside & (~after | first[1:])) + 1
        self.hash = span_hash(chars.fold[codes], self.begin, self.end)
        # Words of text i are at from[i]:from[i + 1].
        self.offsets = np.searchsorted(self.begin, starts)

    def shingles(self, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes of ``size`` words in a row for each text, sorted, with offsets.

        A text of fewer words has one shingle of all its words; one without words has none.
        """
        w, n_texts = self.hash, len(self.offsets) - 1
        step = np.uint64(0x100000001B3)
        out, counts = [], np.zeros(n_texts, np.int64)
        with np.errstate(over="ignore"):
            rolled = np.zeros(max(0, len(w) - size + 1), np.uint64)
            for k in range(size):
                rolled = rolled * step + w[k:k + len(rolled)]
            rolled = mix(rolled)
            for i in range(n_texts):
                a, b = int(self.offsets[i]), int(self.offsets[i + 1])
                if b - a >= size:
                    own = np.sort(rolled[a:b - size + 1])
                    own = own[np.concatenate([[True], own[1:] != own[:-1]])]
                elif b > a:
                    value = np.uint64(b - a)
                    for x in w[a:b]:
                        value = value * step + x
                    own = mix(np.array([value], np.uint64))
                else:
                    continue
                out.append(own)
                counts[i] = len(own)
        values = np.concatenate(out) if out else np.zeros(0, np.uint64)
        return values, np.concatenate([[0], np.cumsum(counts)])


class Lazy:
    """A value that each task makes for itself when first asked; nothing of it travels."""

    def __init__(self, make: Callable[[], object]) -> None:
        self.make, self.made = make, []

    def __call__(self):
        if not self.made:
            self.made.append(self.make())
        return self.made[0]

    def __reduce__(self):
        return Lazy, (self.make,)


def text_udf(work: Callable[[pa.Array], pa.Array], returns: str):
    """A vectorised function of one text column; long batches reach ``work`` in blocks of bounded size."""

    def run(texts):
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        out = [work(block.column("text")) for block in blocks([batch], "text")]
        return pa.concat_arrays(out) if out else work(texts)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, returns)


def word_hash(word: str) -> int:
    """Hash that ``Words`` gives to a word."""
    codes, starts = text_codes(pa.array([word]))
    return int(Words(codes, starts, Characters()).hash[0])


ship(__name__)
