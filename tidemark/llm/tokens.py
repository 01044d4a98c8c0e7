"""Token ids in Parquet: list columns with chosen encodings, row groups and page indexes.

Documents are dealt by ranges of their id, so files and rows follow it. Every file row holds the document's id, its
token count, where it starts inside its file, and the ids. Metadata reads touch only the small columns; page indexes
let a filter on ``doc_id`` skip pages of ids. Where a file starts in the whole stream is a sum over the counts of the
files before it, one row a file.
"""

from __future__ import annotations

import array
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Characters, blocks, ship, shuffle_count, small_batches, span_hash, text_codes

SCHEMA = "part int, doc_id bigint, start_in_part bigint, n_tokens int, ids array<int>"
# Fixed value: the word split of the byte-level vocabulary files.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Pieces and words whose ids a worker remembers; the memory starts anew beyond them.
REMEMBERED, REMEMBERED_WORDS = 1_000_000, 150_000
LONG = 64
# Bytes of text that are encoded together.
STEP_BYTES = 1 << 20


def _encoder(text: str):
    """The tokenizer of this worker process, kept from task to task with the pieces it has seen."""
    kept = sys.modules.setdefault("_kept_token_encoders", types.ModuleType("_kept_token_encoders"))
    key = zlib.crc32(text.encode())
    if key not in kept.__dict__:
        kept.__dict__[key] = PieceEncoder(text)
    return kept.__dict__[key]


class PieceEncoder:
    """Encodes texts piece by piece, each different piece once.

    Before a space that a letter or digit follows, the word split of a byte-level vocabulary always cuts. Ids of a
    text are therefore those of the pieces between such places, one after the other. Pieces are told apart by 64-bit
    hashes, made for a whole block at once; the library's own model encodes every word of a new piece. Pieces of more
    than ``LONG`` characters are always encoded anew. The library encodes whole texts for a tokenizer of another kind,
    and those that hold the name of an added token, at which it cuts.
    """

    def __init__(self, text: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_str(text)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = regex.compile(SPLIT).findall
        pre = self.tokenizer.pre_tokenizer
        self.by_piece = (type(self.tokenizer.model).__name__ == "BPE" and self.tokenizer.normalizer is None
                         and isinstance(pre, ByteLevel) and pre.use_regex and not pre.add_prefix_space)
        # The library names each byte by a printable character; ask it for the names.
        # Bytes that never occur in UTF-8 need none.
        name = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.names = {}
        for c in [*range(0x80), *range(0x80, 0x800), 0x800, 0x1000, *range(0x2000, 0x10000, 0x1000), 0x10000, 0x40000,
                  0x80000, 0xC0000, 0x100000]:
            if not 0xD800 <= c < 0xE000:
                self.names |= dict(zip(chr(c).encode().decode("latin-1"), name(chr(c))[0][0], strict=True))
        self.names = {ord(k): v for k, v in self.names.items()}
        self.word_ids: dict[str, list[int]] = {}
        self.chars = Characters()
        self.forget()

    def forget(self) -> None:
        self.hashes, self.codes = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.starts = array.array("I"), array.array("q", [0])

    def word(self, word: str) -> list[int]:
        found = self.word_ids.get(word)
        if found is None:
            if len(self.word_ids) >= REMEMBERED_WORDS:
                self.word_ids.clear()
            named = word.encode("utf-8", "replace").decode("latin-1").translate(self.names)
            found = self.word_ids[word] = [t.id for t in self.tokenizer.model.tokenize(named)]
        return found

    def learn(self, pieces: list[str], inner: bool) -> None:
        """Encode pieces; ``inner``: each starts with a space and a letter or digit, so all can be split as one text."""
        starts, ids, get = [], self.ids, self.word_ids.get
        if inner:
            for word in self.words("".join(pieces)):
                if word[0] == " " and word[1:2].isalnum():
                    starts.append(len(ids))
                ids.extend(get(word) or self.word(word))
        else:
            for piece in pieces:
                starts.append(len(ids))
                for word in self.words(piece):
                    ids.extend(get(word) or self.word(word))
        self.starts.extend([*starts[1:], len(ids)] if starts else [])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the count of each."""
        if not self.by_piece:
            return self.by_library(texts)
        named = [i for i, text in enumerate(texts) if any(name in text for name in self.added)]
        if not named:
            return self.by_pieces(texts)
        rest = list(texts)
        for i in named:
            rest[i] = ""
        ids, counts = self.by_pieces(rest)
        own, sizes = self.by_library([texts[i] for i in named])
        ids = np.insert(ids, np.repeat((np.cumsum(counts) - counts)[named], sizes), own)
        counts[named] = sizes
        return ids, counts

    def by_library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((i for x in lists for i in x), np.uint32, int(counts.sum())), counts

    def by_pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes, starts = text_codes(pa.array(texts, pa.string()))
        if not len(codes):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        self.chars.learn(codes)
        cut = np.zeros(len(codes), bool)
        cut[:-1] = (codes[:-1] == 32) & self.chars.word[codes[1:]]
        inner = cut.copy()
        first = starts[:-1][starts[:-1] < starts[1:]]
        last = starts[1:][starts[:-1] < starts[1:]] - 1
        inner[last] = cut[last] = False  # the letter behind it is another text's
        cut[first] = True
        begin = np.flatnonzero(cut)
        end = np.concatenate([begin[1:], [len(codes)]])
        keys, at, which = np.unique(span_hash(codes, begin, end), return_index=True, return_inverse=True)
        if len(self.hashes) > REMEMBERED:
            self.forget()
        place = np.searchsorted(self.hashes, keys)
        new = np.ones(len(keys), bool)
        if len(self.hashes):
            new = self.hashes[np.minimum(place, len(self.hashes) - 1)] != keys
        whole = "".join(texts)
        code = np.zeros(len(keys), np.int64)
        code[~new] = self.codes[place[~new]]
        for kind in (True, False):
            some = np.flatnonzero(new & (inner[begin[at]] == kind))
            code[some] = len(self.starts) - 1 + np.arange(len(some))
            self.learn([whole[a:b] for a, b in zip(begin[at[some]].tolist(), end[at[some]].tolist(), strict=True)], kind)
        short = new & (end[at] - begin[at] <= LONG)
        into = place[short]
        self.hashes, self.codes = np.insert(self.hashes, into, keys[short]), np.insert(self.codes, into, code[short])
        long = np.flatnonzero(end - begin > LONG)
        of_piece = code[which]
        if len(long):  # each on its own: equal hashes prove less here
            of_piece[long] = len(self.starts) - 1 + np.arange(len(long))
            self.learn([whole[a:b] for a, b in zip(begin[long].tolist(), end[long].tolist(), strict=True)], False)
        known, bounds = np.frombuffer(self.ids, np.uint32), np.frombuffer(self.starts, np.int64)
        n = (bounds[1:] - bounds[:-1])[of_piece]
        upto = np.cumsum(n)
        ids = known[np.repeat(bounds[of_piece] - (upto - n), n) + np.arange(int(upto[-1]))]
        sums = np.concatenate([[0], upto])[np.searchsorted(begin, starts)]
        return ids, np.diff(sums)


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 0, partitions: int | None = None,
                 row_group_bytes: int = 16 << 20, page_rows: int = 2000, dictionary: bool = True) -> None:
    """Encode ``text`` of every document and write the ids by ascending ``doc_id``.

    Null text is empty and gives the end id alone. Repeated rows stay; rows of one id go by a hash of their text, so
    a much repeated id still spreads. Null ids come first. Other columns are not looked at. ``dictionary=False``
    writes ids with delta encoding instead.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())  # bounded: one vocabulary file

    def encode(batches):
        encoder, part, start = _encoder(shared.value), TaskContext.get().partitionId(), 0
        for block in blocks(batches, "text", STEP_BYTES):
            ids, counts = encoder.encode([t or "" for t in block.column("text").to_pylist()])
            ends = np.cumsum(counts)
            ids = np.insert(ids.astype(np.int32), ends, np.int32(end_id))
            counts = counts + 1
            offsets = np.concatenate([[0], np.cumsum(counts)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part), pa.int32()), block.column("doc_id").combine_chunks(),
                 pa.array(offsets[:-1] + start), pa.array(counts, pa.int32()), lists],
                names=["part", "doc_id", "start_in_part", "n_tokens", "ids"])
            start += int(offsets[-1])

    ranged = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("spread", F.xxhash64("text"))
        .repartitionByRange(partitions or shuffle_count(spark), "doc_id", "spread")
        .sortWithinPartitions("doc_id", "spread").select("doc_id", "text")
    )
    (ranged.mapInArrow(encode, SCHEMA).write
     .option("parquet.block.size", row_group_bytes).option("parquet.page.row.count.limit", page_rows)
     .option("parquet.writer.version", "PARQUET_1_0" if dictionary else "PARQUET_2_0")
     .option("parquet.enable.dictionary", "false")
     .option("parquet.enable.dictionary#ids.list.element", str(dictionary).lower())
     .parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files as written."""
    return spark.read.schema(SCHEMA).parquet(path)


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part, before``: ids in all files before each file; reads two small columns."""
    totals = read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def token_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens`` without reading ids."""
    return (
        read_tokens(spark, path).join(F.broadcast(file_starts(spark, path)), "part")  # bounded: one row a file
        .select("doc_id", (F.col("start_in_part") + F.col("before")).alias("start"),
                F.col("n_tokens").cast("long").alias("n_tokens"))
    )


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files; the checksum is over little-endian 32-bit ids."""

    def digest(batches):
        for batch in batches:
            lists = batch.column("ids")
            offsets = np.asarray(lists.offsets)
            ids = np.ascontiguousarray(np.asarray(lists.values), dtype="<u4")
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("doc_id"), batch.column("start_in_part"), batch.column("n_tokens"),
                 pa.array(crcs, pa.int64())],
                names=["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"])

    small_batches(spark)
    rows = read_tokens(spark, path).mapInArrow(
        digest, "part int, doc_id bigint, start_in_part bigint, n_tokens int, ids_crc32 bigint")
    return (
        rows.join(F.broadcast(file_starts(spark, path)), "part")  # bounded: one row a file
        .select("doc_id", (F.col("start_in_part") + F.col("before")).alias("start"),
                F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")
    )


ship(__name__)
