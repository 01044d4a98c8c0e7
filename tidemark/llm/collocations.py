"""Phrases that occur together more often than their parts would by chance, mined with stripes.

A stripe belongs to a prefix of 0 to 4 words of one language and counts what comes next. A task makes one stripe for each
prefix in its texts, stripes of one prefix meet in a shuffle and are merged element by element. Everything is read off
the merged stripes: an entry is the frequency of a longer phrase, the sum of the empty prefix's stripe is the number of
words, any other prefix has its total as an entry of a shorter one, and the greatest entry says whether a longer phrase
takes the prefix in.

Prefixes grow by one word a level, and only what is frequent has an entry. A level first counts the 64-bit hashes of
phrases whose beginning and end are frequent, which deals all of them evenly to tasks, however common a word is. Those
that reach the least number are sent to all tasks as a bitmap of ``BITS`` bits, whatever the corpus; then the stripes are
made of the phrases in it. A bit may be set by another phrase too, which costs some counting and changes no result, for
the entries count the phrases themselves.

Texts are cut into words once; every level reads their codes. A stripe is cut into parts by the hash of the next word, so
that none stands for more than its share of all words, of which there are ``SHARES`` for each shuffle partition; fewer
prefixes than shares can need that, so their list has a bound as well.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_blocks, kept, mix, ship, shuffle_count, small_batches
from tidemark.llm.wordblocks import byte_set, word_block, word_hashes

LONGEST = 5  # words of a phrase
LEAST = 100  # occurrences
BITS = 1 << 26
SHARES = 4
SALTS = 16

SPACES = byte_set(" \t")
ENDS = byte_set(".,;:!?\n\x0b\x0c\r")

# Bytes of the texts that share a list of words.
BLOCK_BYTES = 4 << 20
# Entries of stripes, and hashes, that a task holds before it merges them.
STEP, HASH_STEP = 1 << 18, 1 << 22

TOKENS = "words array<string>, langs array<string>, codes binary, piece_words binary, piece_lang binary"
PACKED = "part int, hashes binary, counts binary, n int"
STRIPE = "lang string, prefix string, hash bigint, parts int, part int, rest bigint, nexts array<string>, counts array<bigint>"
MERGED = ("lang string, prefix string, total bigint, nexts array<string>, counts array<bigint>, hashes array<bigint>, "
          "most bigint")


def _tokens(block: pa.Table) -> pa.RecordBatch | None:
    """One row for a block: its words and languages once, the code of every word, and each piece's words and language."""
    found = word_block(block.column("text"), SPACES, ENDS)
    if not len(found.codes):
        return None
    langs = pc.fill_null(block.column("lang").combine_chunks().cast(pa.string()), "und").dictionary_encode()
    langs = langs.combine_chunks() if isinstance(langs, pa.ChunkedArray) else langs
    lang = langs.indices.to_numpy(zero_copy_only=False)[found.text]
    first = np.flatnonzero(np.diff(found.piece, prepend=-1))
    sizes = np.diff(np.append(first, len(found.codes)))
    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (found.words, langs.dictionary)]
    packed = [pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in (found.codes, sizes, lang[first])]
    return pa.RecordBatch.from_arrays([*lists, *packed], names=["words", "langs", "codes", "piece_words", "piece_lang"])


def _grow(hashes: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Hash of a phrase and one more word."""
    with np.errstate(over="ignore"):
        return mix(hashes * np.uint64(0x9E3779B97F4A7C15) + following)


def _set(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes % np.uint64(BITS)
    return (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


class _Places:
    """Where the phrases of a block are that have ``size`` words in front of the last one.

    ``at`` are the places of prefixes that one more word follows in their piece, where the prefix and the end of the
    longer phrase are frequent; ``own`` has the hash of each prefix, ``longer`` that of the phrase.
    """

    def __init__(self, row: dict, size: int, frequent: np.ndarray | None) -> None:
        self.words, self.langs = row["words"].values, row["langs"].values
        self.codes = np.frombuffer(row["codes"].as_buffer(), np.int32).astype(np.int64)
        sizes = np.frombuffer(row["piece_words"].as_buffer(), np.int32)
        n = len(self.codes)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)  # words to the end of the piece, with this one
        self.lang = np.repeat(np.frombuffer(row["piece_lang"].as_buffer(), np.int32), sizes).astype(np.int64)
        self.hash = word_hashes(self.words)
        last = max(0, n - max(size, 1) + 1)
        own = word_hashes(self.langs)[self.lang[:last]]
        for j in range(size):
            own = _grow(own, self.hash[self.codes[j:j + last]])
        if size:
            often = (left[:len(own)] >= size) & _set(frequent, own)
            self.at = np.flatnonzero(often[:-1] & often[1:] & (left[:len(own) - 1] > size)) if len(own) else np.zeros(0, int)
        else:
            self.at = np.arange(n)
        self.own = own[self.at]
        self.longer = _grow(self.own, self.hash[self.codes[self.at + size]])


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i] for name in batch.schema.names}


def _summed(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes in order, with the sums of their counts."""
    both = np.concatenate(hashes)
    order = np.argsort(both, kind="stable")
    both, times = both[order], np.concatenate(counts)[order]
    first = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.zeros(0, int)
    return both[first], np.add.reduceat(times, first) if len(first) else times


def _bytes_apart(values: np.ndarray) -> bytes:
    """First bytes of all numbers, then second ones, and so on: what they share packs well."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _together(data: bytes, kind: type, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(kind).ravel() if n else np.zeros(0, kind)


def _packed_hashes(batches, size: int, frequent: np.ndarray | None, parts: int):
    """Hashes of a task's phrases with their counts, dealt to ``parts`` by themselves."""
    hashes, counts, held = [], [], 0

    def out():
        values, times = _summed(hashes, counts)
        # Parts are ranges, so that each is in order.
        bounds = np.searchsorted(values, (np.arange(1, parts, dtype=np.float64) * (2.0 ** 64 / parts)).astype(np.uint64))
        for part, (a, b) in enumerate(zip([0, *bounds], [*bounds, len(values)], strict=True)):
            if b > a:
                yield (part, _bytes_apart(np.diff(values[a:b], prepend=np.uint64(0))), _bytes_apart(times[a:b].astype(np.uint32)), b - a)

    def batch():
        rows = list(zip(*out(), strict=True))
        if rows:
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int32()), pa.array([pa.compress(x, "zstd", asbytes=True) for x in rows[1]], pa.binary()),
                 pa.array([pa.compress(x, "zstd", asbytes=True) for x in rows[2]], pa.binary()), pa.array(rows[3], pa.int32())],
                names=["part", "hashes", "counts", "n"])

    for row in _rows(batches):
        found, times = np.unique(_Places(row, size, frequent).longer, return_counts=True)
        hashes.append(found)
        counts.append(times.astype(np.uint32))
        held += len(found)
        if held >= HASH_STEP:
            merged = _summed(hashes, counts)
            hashes, counts, held = [merged[0]], [merged[1]], 0
            if len(merged[0]) >= HASH_STEP:
                yield batch()
                hashes, counts = [], []
    if hashes:
        made = batch()
        if made is not None:
            yield made


def _frequent_hashes(batches, least: int):
    """Hashes that reach ``least``, from packed rows in order of their parts."""
    part, hashes, counts, held = None, [], [], 0

    def out():
        values, times = _summed(hashes, counts)
        return pa.RecordBatch.from_arrays([pa.array(values[times >= least].view(np.int64))], names=["hashes"])

    for row in _rows(batches):
        n = row["n"].as_py()
        if row["part"].as_py() != part and hashes:
            yield out()
            hashes, counts, held = [], [], 0
        part = row["part"].as_py()
        unpacked = [pa.decompress(row[c].as_buffer(), decompressed_size=n * width, codec="zstd", asbytes=True)
                    for c, width in (("hashes", 8), ("counts", 4))]
        hashes.append(np.cumsum(_together(unpacked[0], np.uint64, n), dtype=np.uint64))
        counts.append(_together(unpacked[1], np.uint32, n).astype(np.int64))
        held += n
        if held >= HASH_STEP:
            merged = _summed(hashes, counts)
            hashes, counts, held = [merged[0]], [merged[1]], 0
    if hashes:
        yield out()


def row_stripes(row: dict, size: int, frequent: np.ndarray | None, wanted: np.ndarray | None,
                hot: tuple[np.ndarray, np.ndarray], root_parts: int) -> pa.Table | None:
    """Stripes of prefixes of ``size`` words in a block, of phrases in ``wanted``; ``hot``: sorted hashes and parts.

    Stripes of the empty prefix have the other words as their ``rest``.
    """
    places = _Places(row, size, frequent)
    chosen = _set(wanted, places.longer) if wanted is not None else np.zeros(len(places.at), bool)
    rest = np.bincount(places.lang[places.at[~chosen]], minlength=len(places.langs)) if size == 0 else None
    at, own = places.at[chosen], places.own[chosen]
    vocabulary = len(places.words)
    prefix = places.lang[at]
    for j in range(size):
        prefix = np.unique(prefix * vocabulary + places.codes[at + j], return_inverse=True)[1]
    pairs, sample, times = np.unique(prefix * vocabulary + places.codes[at + size], return_index=True, return_counts=True)
    owner, nexts, sample = pairs // vocabulary, pairs % vocabulary, sample
    hashes, spot = own[sample], at[sample]
    parts = np.full(len(pairs), root_parts if size == 0 else 1, np.int64)
    if size and len(hot[0]):
        place = np.minimum(np.searchsorted(hot[0], hashes), len(hot[0]) - 1)
        parts = np.where(hot[0][place] == hashes, hot[1][place], 1)
    part = (places.hash[nexts] % parts.astype(np.uint64)).astype(np.int64)
    order = np.lexsort((part, owner))
    owner, part, nexts, times, spot, hashes, parts = (x[order] for x in (owner, part, nexts, times, spot, hashes, parts))
    head = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
    spelled = [places.words.take(pa.array(places.codes[spot[head] + j])) for j in range(size)]
    lists = pa.array(np.append(head, len(pairs)), pa.int32())
    out = pa.table([
        places.langs.take(pa.array(places.lang[spot[head]])),
        pc.binary_join_element_wise(*spelled, " ") if size else pa.array([""] * len(head), pa.string()),
        pa.array(hashes[head].view(np.int64)), pa.array(parts[head], pa.int32()), pa.array(part[head], pa.int32()),
        pa.array(np.zeros(len(head), np.int64)), pa.ListArray.from_arrays(lists, places.words.take(pa.array(nexts))),
        pa.ListArray.from_arrays(lists, pa.array(times, pa.int64()))], names=_NAMES)
    if size == 0:
        some = np.flatnonzero(rest)
        k = len(some)
        nothing = pa.ListArray.from_arrays(pa.array([0] * (k + 1), pa.int32()), pa.array([], pa.string()))
        none = pa.ListArray.from_arrays(pa.array([0] * (k + 1), pa.int32()), pa.array([], pa.int64()))
        root = word_hashes(places.langs)[some].view(np.int64)
        out = pa.concat_tables([out, pa.table([
            places.langs.take(pa.array(some)), pa.array([""] * k, pa.string()), pa.array(root), pa.array([root_parts] * k, pa.int32()),
            pa.array([0] * k, pa.int32()), pa.array(rest[some].astype(np.int64)), nothing, none], names=_NAMES)])
    return out if out.num_rows else None


_NAMES = [field.split(" ")[0] for field in STRIPE.split(", ")]
_KEY = [("lang", "ascending"), ("prefix", "ascending"), ("part", "ascending")]


def _task_stripes(batches, size, frequent, wanted, hot, root_parts):
    """Stripes of a task, merged over its blocks."""
    held, entries = [], 0
    for row in _rows(batches):
        made = row_stripes(row, size, frequent, wanted, hot, root_parts)
        if made is None:
            continue
        held.append(made)
        entries += made.num_rows + len(pc.list_flatten(made.column("nexts")))
        if entries >= 4 * STEP:
            merged = _added(pa.concat_tables(held).sort_by(_KEY))
            held, entries = [merged], 0
            if merged.num_rows + len(pc.list_flatten(merged.column("nexts"))) >= 2 * STEP:
                yield from merged.to_batches()
                held = []
    if held:
        yield from _added(pa.concat_tables(held).sort_by(_KEY)).to_batches()


def _added(rows: pa.Table) -> pa.Table:
    """Stripes in the order of their keys, those of one key merged."""
    same = np.ones(rows.num_rows - 1, bool)
    for name in ("lang", "prefix", "part"):
        column = rows.column(name).combine_chunks()
        same &= pc.equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    key = np.concatenate([[0], np.cumsum(~same)])
    first = np.concatenate([[0], np.flatnonzero(~same) + 1])
    sizes = pc.list_value_length(rows.column("nexts")).to_numpy().astype(np.int64)
    flat = pa.table({"key": np.repeat(key, sizes), "next": pc.list_flatten(rows.column("nexts")),
                     "count": pc.list_flatten(rows.column("counts"))})
    flat = flat.group_by(["key", "next"]).aggregate([("count", "sum")]).sort_by("key")
    bounds = pa.array(np.searchsorted(flat.column("key").to_numpy(), np.arange(len(first) + 1)), pa.int32())
    heads = rows.take(pa.array(first))
    lists = [pa.ListArray.from_arrays(bounds, _whole(flat.column(c))) for c in ("next", "count_sum")]
    rest = np.add.reduceat(rows.column("rest").to_numpy(), first)
    return pa.table([*(heads.column(c) for c in ("lang", "prefix", "hash", "parts", "part")), pa.array(rest), *lists],
                    names=rows.schema.names)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    array = column.combine_chunks()
    return array.chunk(0) if isinstance(array, pa.ChunkedArray) else array


def merge_stripes(batches, least: int):
    """Merged stripes: their sums, and the entries of ``least`` and more."""

    def out(done: pa.Table) -> pa.RecordBatch | None:
        if not done.num_rows:
            return None
        nexts, counts = _whole(done.column("nexts")), _whole(done.column("counts"))
        sizes = pc.list_value_length(nexts).to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(done.num_rows), sizes)
        flat, times = pc.list_flatten(nexts), pc.list_flatten(counts).to_numpy(zero_copy_only=False)
        total = _whole(done.column("rest")).to_numpy(zero_copy_only=False) + np.bincount(
            owner, times, minlength=done.num_rows).astype(np.int64)
        most = np.zeros(done.num_rows, np.int64)
        np.maximum.at(most, owner, times)
        much = np.flatnonzero(times >= least)
        owner, flat, times = owner[much], flat.take(pa.array(much)), times[much]
        keep = (np.bincount(owner, minlength=done.num_rows) > 0) | pc.equal(
            _whole(done.column("prefix")), "").to_numpy(zero_copy_only=False)
        hashes = _grow(_whole(done.column("hash")).to_numpy(zero_copy_only=False).view(np.uint64)[owner], word_hashes(flat))
        bounds = pa.array(np.searchsorted(owner, np.arange(done.num_rows + 1)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [_whole(done.column("lang")), _whole(done.column("prefix")), pa.array(total),
             pa.ListArray.from_arrays(bounds, flat), pa.ListArray.from_arrays(bounds, pa.array(times)),
             pa.ListArray.from_arrays(bounds, pa.array(hashes.view(np.int64))), pa.array(most)],
            names=["lang", "prefix", "total", "nexts", "counts", "hashes", "most"]).filter(pa.array(keep))

    held, entries = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        entries += batch.num_rows + len(batch.column("nexts").flatten())
        if entries >= STEP:
            merged = _added(pa.concat_tables(held))
            # The last stripe may go on in the next batch.
            done = out(merged.slice(0, merged.num_rows - 1))
            held = [merged.slice(merged.num_rows - 1)]
            entries = 0
            if done is not None and done.num_rows:
                yield done
    if held:
        done = out(_added(pa.concat_tables(held)))
        if done.num_rows:
            yield done


def stripes(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """``size, lang, prefix, total, nexts, counts, hashes, most``: merged stripes with their frequent entries, some in parts."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    tokens = kept(rows.mapInArrow(in_blocks(_tokens, "text", BLOCK_BYTES), TOKENS), "phrase-tokens", compression="zstd")
    partitions = shuffle_count(spark)
    shares = SHARES * partitions
    levels, words, last, hot = [], 0, spark.sparkContext.broadcast(None), (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    for size in range(longest):
        packed = tokens.mapInArrow(lambda b, size=size, last=last: _packed_hashes(b, size, last.value, shares), PACKED)
        frequent = _bitmap(packed.repartition(partitions, "part").sortWithinPartitions("part").mapInArrow(
            lambda b: _frequent_hashes(b, least), "hashes bigint"))
        if frequent is None and size:
            break
        wanted = spark.sparkContext.broadcast(frequent)

        def cut(batches, size=size, last=last, wanted=wanted, hot=hot):
            return _task_stripes(batches, size, last.value, wanted.value, hot, shares)

        met = tokens.mapInArrow(cut, STRIPE).repartition(partitions, "lang", "prefix", "part")
        level = kept(met.sortWithinPartitions("lang", "prefix", "part").mapInArrow(
            lambda b: merge_stripes(b, least), MERGED), f"stripes-{size}")
        levels.append(level.withColumn("size", F.lit(size)))
        if size == 0:
            words = level.agg(F.sum("total")).first()[0] or 0
        if frequent is None:
            break
        last = wanted
        much = (level.select(F.explode(F.arrays_zip("hashes", "counts")).alias("e")).select("e.hashes", "e.counts")
                .where(F.col("counts") * shares > words).toArrow())
        order = np.argsort(much.column("hashes").to_numpy().view(np.uint64))
        parts = -(-much.column("counts").to_numpy().astype(float) * shares // max(words, 1))
        hot = (much.column("hashes").to_numpy().view(np.uint64)[order], parts.astype(np.int64)[order])
    return reduce(DataFrame.unionByName, levels)


def _bitmap(entries: DataFrame) -> np.ndarray | None:
    """Bits of the hashes of frequent phrases; at most ``BITS`` / 64 numbers reach the driver."""
    slot = F.expr(f"pmod(pmod(hashes, {BITS}L) + CASE WHEN hashes < 0 THEN {(1 << 64) % BITS}L ELSE 0L END, {BITS}L)")
    parts = (entries.select(slot.alias("slot")).groupBy(F.expr("shiftright(slot, 6)").alias("at"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63L AS int)))").alias("bits"))).toArrow()
    if not parts.num_rows:
        return None
    out = np.zeros(BITS // 64, np.int64)
    out[parts.column("at").to_numpy()] = parts.column("bits").to_numpy()
    return out.view(np.uint8)


def collocations(docs: DataFrame, top: int = 2000, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of every language.

    ``docs`` has text and lang; other columns are left alone. A-Z count as lower case. ``.,;:!?`` and line ends part
    pieces, spaces and tabs part words. A phrase of 2 to ``longest`` words counts with all its occurrences within pieces,
    overlaps included, and is a candidate from ``least`` on. Its score is the least over all cuts of
    floor(1000 a n / (l r)). Phrases that a longer candidate holds as often are left out. Null texts are empty, null
    languages count as ``und``, repeated rows count each; ties of score go by ``a`` and then by phrase. Empty tables and
    corpora without a frequent phrase give no rows.
    """
    found = stripes(docs, least, longest)
    words = found.where("size = 0").groupBy("lang").agg(F.sum("total").alias("n"))
    often = kept(found.select("lang", "size", "prefix", F.explode(F.arrays_zip("nexts", "counts")).alias("e")).select(
        "lang", F.when(F.col("size") == 0, F.col("e.nexts")).otherwise(F.concat_ws(" ", "prefix", "e.nexts")).alias("phrase"),
        F.col("e.counts").alias("f"), "size"), "phrases")
    # The greatest entry of a whole stripe, parts together.
    most = found.where("size > 0").groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max("most").alias("most"))
    longer = often.where("size > 0").select("lang", "phrase", F.col("f").alias("a"))
    listed = longer.withColumn("w", F.split("phrase", " "))
    # What takes a candidate in: a longer one to its right or to its left.
    left = (listed.where(F.size("w") > 2).groupBy("lang", F.expr("array_join(slice(w, 2, size(w) - 1), ' ')").alias("phrase"))
            .agg(F.max("a").alias("before")))
    free = (listed.join(left, ["lang", "phrase"], "left")
            .join(most, ["lang", "phrase"], "left")
            .where("a > coalesce(before, 0) AND a > coalesce(most, 0)").select("lang", "phrase", "a", "w"))
    cuts = (free.withColumn("k", F.explode(F.expr("sequence(1, size(w) - 1)")))
            .select("lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("head"),
                    F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("tail")))
    part = lambda name, value: often.select("lang", F.col("phrase").alias(name), F.col("f").alias(value))
    scored = (cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"]).join(words, "lang")
              .withColumn("score", F.expr("(cast(1000 AS decimal(4,0)) * cast(a AS decimal(15,0)) * cast(n AS decimal(18,0)))"
                                          " div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))"))
              .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    # The best of each salt first, so that a task ranks no more than SALTS times ``top`` rows of a language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(
        F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ship(__name__)
