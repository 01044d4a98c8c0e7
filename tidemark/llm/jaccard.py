"""Similarity join of documents on word shingles, by chosen paths.

Sets are split by the values they share. A node of the recursion picks one or two of the ``COORDINATES`` minhashes,
1 / ``THRESHOLD`` on average, by a hash of the path and the run, and its sets go to one child for each value there. A
pair of the threshold's similarity stays together on 1 child on average, and unlike sets part quickly. Buckets of up to
``SMALL`` sets are compared by brute force. ``RUNS`` runs share the minhashes and reach the target recall of paths that
end early; sets whose paths were split more often go through further rounds of runs, each on minhashes of its own, until
the chance that all rounds miss a partner is small enough at the depth that their paths reached. In a larger bucket all
sets are first compared with one of them: those near it are linked to it and leave (any partner of theirs is near
enough to be linked to it as well, by the triangle inequality), and the rest is split further. So a large group of
near copies costs one comparison each. Two sets linked to one pivot are gathered already, so a child bucket of such
sets only is done.

Estimated links only gather sets that may be similar. A gathering of more than ``SPLIT_SETS`` sets, such as the pages of one
template, is split on by the shared tokens themselves: in any one order of its shingles, the first fifth of a set and
one more hold a shingle of the first fifth of every partner's. The order puts first what a sample of the gathering
seldom holds, so sets that share only a common passage part. Inside what stays together all pairs are checked exactly
on their shingles, in blocks, and only sums and a spanning forest of links leave a task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Characters, Lazy, Words, in_blocks, kept, mix, release, shuffle_count, ship, small_batches, text_codes, \
    text_udf
from tidemark.llm.components import components

SHINGLE = 5  # words
THRESHOLD = 0.8  # of the exact Jaccard similarity, as 4 / 5 in whole numbers below
COORDINATES = 64
TARGET = 0.99  # recall of a pair at the threshold
SMALL = 1024
# Estimates from minhashes: candidates from here on; near the pivot from there on; linked to the pivot from the last on.
# A set that agrees with the pivot on NEAR of the minhashes and with a partner on k of them leaves the partner at least
# NEAR + k / COORDINATES - 1 of the pivot's, so the partner misses LINKED only by a chance that ``lost_at_pivot`` bounds.
CANDIDATE, NEAR, LINKED = 0.4, 0.7, 0.28
# Gatherings of more sets than this are split before the exact check; up to it, a few blocks of pairs cost less.
SPLIT_SETS = 4096
# Sample that orders the shingles of a large gathering, on average, and how often it has to hold a shingle that goes last.
# Any order gives the same links, so the sample decides only how far the gathering splits.
SAMPLE_SETS, SAMPLE_SHINGLES, OFTEN = 256, 1 << 20, 3
# Shingles and sets of one block of the exact check, on average.
BLOCK_SHINGLES, BLOCK_SETS = 1 << 20, 2048


def survival(similarity: float, depth: int) -> float:
    """Chance that a pair shares a bucket after ``depth`` splits of one run, 1 / THRESHOLD coordinates each."""
    extra = 1 / THRESHOLD - 1
    p = 1.0
    for _ in range(depth):
        one = 1 - similarity * p
        p = 1 - ((1 - extra) * one + extra * one * one)
    return p


def missed(depth: int, runs: int) -> float:
    """Chance that ``runs`` runs on the same minhashes all part a pair at the threshold within ``depth`` splits.

    The runs are independent only for a given number of minhashes that agree, so it is averaged over that number.
    """
    return sum(comb(COORDINATES, k) * THRESHOLD ** k * (1 - THRESHOLD) ** (COORDINATES - k)
               * (1 - survival(k / COORDINATES, depth)) ** runs for k in range(COORDINATES + 1))


def runs_needed(target: float = TARGET, depth: int = 4) -> int:
    return next(r for r in range(1, 1 << 10) if missed(depth, r) <= 1 - target)


RUNS = runs_needed()  # of one round; deeper paths take further rounds


def lost_at_pivot() -> float:
    """Largest chance that a partner of a set near the pivot is not linked to the pivot."""
    near, linked = ceil(NEAR * COORDINATES), ceil(LINKED * COORDINATES)
    return sum(comb(COORDINATES, k) * THRESHOLD ** k * (1 - THRESHOLD) ** (COORDINATES - k)
               for k in range(linked + COORDINATES - near))


def _seeds(count: int, turn: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(11 + turn)
    odd = draw.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, draw.integers(0, 1 << 63, count, dtype=np.uint64)


def set_hash(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 64-bit number for each set of shingles; equal sets have equal ones."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(values + np.uint64(0x9E3779B97F4A7C15)))]).astype(np.uint64)
        return mix(sums[offsets[1:]] - sums[offsets[:-1]] + (offsets[1:] - offsets[:-1]).astype(np.uint64)).view(np.int64)


def signatures(values: np.ndarray, offsets: np.ndarray, turn: int = 0) -> np.ndarray:
    """Minhashes of a round, one row a set; empty sets have zeros."""
    odd, add = _seeds(COORDINATES, turn)
    out = np.zeros((len(offsets) - 1, COORDINATES), np.uint32)
    some = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(some):
        with np.errstate(over="ignore"):
            for k in range(COORDINATES):
                hashed = ((values * odd[k] + add[k]) >> np.uint64(32)).astype(np.uint32)
                out[some, k] = np.minimum.reduceat(hashed, offsets[:-1][some])
    return out


def children(paths: np.ndarray, sets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and their child paths: one coordinate for each path, and a second one for a share of the paths."""
    with np.errstate(over="ignore"):
        draw = mix(paths.view(np.uint64) + np.uint64(0x632BE59BD9B4E019))
        first = (draw % np.uint64(COORDINATES)).astype(np.int64)
        second = (first + 1 + ((draw >> np.uint64(8)) % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
        twice = (draw >> np.uint64(40)) % np.uint64(1000) < np.uint64(round(1000 * (1 / THRESHOLD - 1)))
        rows = np.arange(len(paths))
        out = []
        for pick, on in ((first, rows), (second, rows[twice])):
            value = sets[on, pick[on]].astype(np.uint64) + (pick[on].astype(np.uint64) << np.uint64(32))
            out.append((on, mix(mix(paths[on].view(np.uint64)) * np.uint64(31) + value).view(np.int64)))
        return out


def sets_of(docs: DataFrame, turn: int = 0) -> DataFrame:
    """``doc_id, node, n, sig``: set hash, number of distinct shingles and minhashes (of a round) of every document.

    ``node`` is null where a text has no word.
    """
    small_batches(docs.sparkSession)
    held = Lazy(Characters)

    def work(block: pa.Table):
        codes, starts = text_codes(block.column("text"))
        values, offsets = Words(codes, starts, held()).shingles(SHINGLE)
        n = np.diff(offsets)
        sig = signatures(values, offsets, turn)
        return pa.RecordBatch.from_arrays(
            [block.column("doc_id").combine_chunks(), pa.array(set_hash(values, offsets), mask=n == 0), pa.array(n),
             pa.array([r.tobytes() for r in sig], pa.binary())], names=["doc_id", "node", "n", "sig"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(in_blocks(work, "text"), "doc_id bigint, node bigint, n bigint, sig binary")


def node_of(docs: DataFrame, text: str = "text"):
    """The set hash of a text column, as in ``sets_of``."""
    small_batches(docs.sparkSession)
    held = Lazy(Characters)

    def work(texts):
        codes, starts = text_codes(texts)
        values, offsets = Words(codes, starts, held()).shingles(SHINGLE)
        return pa.array(set_hash(values, offsets), mask=np.diff(offsets) == 0)

    return text_udf(work, "bigint")(F.col(text).cast("string"))


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), -1)


def _root_paths(sets: DataFrame, turn: int, runs: int) -> DataFrame:
    """``bucket, node`` after the first split of every run of a round."""
    first = turn * RUNS

    def split(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            node, sig = batch.column("node").to_numpy(), _matrix(batch.column("sig"))
            paths, nodes = [], []
            for run in range(first, first + runs):
                for on, child in children(np.full(len(node), run * 7919 + 1, np.int64), sig):
                    paths.append(child)
                    nodes.append(node[on])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(paths)), pa.array(np.concatenate(nodes))],
                                             names=["bucket", "node"])

    return sets.mapInArrow(split, "bucket bigint, node bigint")


def _groups(batches, key_columns: list[str], limit: int):
    """Tables of whole groups from rows sorted by key, of about ``limit`` rows (one group may be more)."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        total += batch.num_rows
        if total < limit:
            continue
        table = pa.Table.from_batches(held)
        keys = [table.column(k).to_numpy() for k in key_columns]
        same = np.ones(total - 1, bool)
        for k in keys:
            same &= k[1:] == k[:-1]
        cut = np.flatnonzero(~same)
        if len(cut):
            at = int(cut[-1]) + 1
            yield table.slice(0, at)
            held = table.slice(at).to_batches()
            total -= at
    if held:
        yield pa.Table.from_batches(held)


def _begins(*keys: np.ndarray) -> np.ndarray:
    change = np.zeros(len(keys[0]), bool)
    change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.concatenate([np.flatnonzero(change), [len(change)]])


def _lowest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of ``n`` items is linked to, directly or through others."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _compare_small(batches):
    """Spanning links of each bucket's candidates."""
    for table in _groups(batches, ["bucket"], 4096):
        node, sig = table.column("node").to_numpy(), _matrix(table.column("sig"))
        begins = _begins(table.column("bucket").to_numpy())
        sizes = np.diff(begins)
        # All pairs of each bucket: for each row, the rows behind it.
        behind = np.repeat(begins[1:], sizes) - np.arange(len(node)) - 1
        left, right = [], []
        row = 0
        upto = np.cumsum(behind)
        while row < len(node):
            end = max(row + 1, int(np.searchsorted(upto, (upto[row - 1] if row else 0) + (1 << 17), side="right")))
            n = behind[row:end]
            a = np.repeat(np.arange(row, end), n)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            like = (sig[a] == sig[b]).mean(axis=1) >= CANDIDATE if len(a) else np.zeros(0, bool)
            left.append(a[like])
            right.append(b[like])
            row = end
        label = _lowest(len(node), np.concatenate(left), np.concatenate(right))
        out = np.flatnonzero(label != np.arange(len(node)))
        if len(out):
            yield pa.RecordBatch.from_arrays([pa.array(node[out]), pa.array(node[label[out]])], names=["a", "b"])


def _compare_pivot(batches):
    """Each row of a large bucket against the pivot; rows not near it come with their child paths."""
    for batch in batches:
        if not batch.num_rows:
            continue
        node, pivot = batch.column("node").to_numpy(), batch.column("pivot").to_numpy()
        sig = _matrix(batch.column("sig"))
        like = (sig == _matrix(batch.column("pivot_sig"))).mean(axis=1)
        bucket = batch.column("bucket").to_numpy()
        stay = np.flatnonzero((like < NEAR) & (node != pivot))
        rows = [(node[i], pivot[i], None, None) for i in np.flatnonzero((like >= LINKED) & (node != pivot)).tolist()]
        for on, child in children(bucket[stay], sig[stay]):
            linked = (like[stay[on]] >= CANDIDATE).tolist()
            rows += [(n, None, c, on_pivot) for n, c, on_pivot in zip(node[stay[on]].tolist(), child.tolist(), linked, strict=True)]
        if rows:
            a, b, c, d = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (a, b, c)), pa.array(d, pa.bool_())],
                                             names=["node", "pivot", "bucket", "linked"])


def _round(sets: DataFrame, turn: int, runs: int, before: float) -> tuple[DataFrame, list[DataFrame], int]:
    """``a, b`` links of one round, tables of ``node, own`` for the depths whose paths may yet lose a pair, and the depth.

    ``own`` is the chance that the round missed a pair at that depth; ``before`` is the largest chance that all earlier
    rounds did.
    """
    spark = sets.sparkSession
    rows = _root_paths(sets, turn, runs).withColumn("linked", F.lit(False))
    links, small, deep, depth = [], [], [], 1
    while True:
        # A path's bucket is used in one place only, so rows alone in theirs are done.
        rows = kept(rows, "paths")
        own = missed(depth, runs)
        if before * own > 1 - TARGET:
            deep.append(kept(rows.select("node").distinct(), "deep").withColumn("own", F.lit(own)))
        sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("pivot"),
                                           F.bool_and("linked").alias("done")).where("size > 1 AND NOT done").drop("done")
        rows = kept(rows.select("bucket", "node").join(sizes, "bucket"), "buckets")
        small.append(rows.where(F.col("size") <= SMALL).select("bucket", "node"))
        large = rows.where(F.col("size") > SMALL)
        if large.isEmpty():
            break
        signed = large.select("bucket", "node", "pivot").join(sets.select("node", "sig"), "node")
        heads = signed.where("node = pivot").select("bucket", F.col("sig").alias("pivot_sig"))
        compared = kept(signed.join(heads, "bucket")
                        .select("bucket", "node", "sig", "pivot", "pivot_sig")
                        .mapInArrow(_compare_pivot, "node bigint, pivot bigint, bucket bigint, linked boolean"), "pivots")
        links.append(compared.where("pivot is not null").selectExpr("node AS a", "pivot AS b"))
        rows = compared.where("bucket is not null").select("bucket", "node", "linked")
        depth += 1
        del sizes, large, signed, heads, compared
        release(spark)
    rows = reduce(DataFrame.unionAll, small).join(sets.select("node", "sig"), "node").select("bucket", "node", "sig")
    rows = rows.repartition(shuffle_count(spark), "bucket").sortWithinPartitions("bucket", "node")
    return reduce(DataFrame.unionAll, links, rows.mapInArrow(_compare_small, "a bigint, b bigint")), deep, depth


def candidate_links(sets: DataFrame, fresh: Callable[[int], DataFrame]) -> DataFrame:
    """``a, b``: links that span every gathering of sets that may be similar. ``sets``: node (unique), sig.

    ``fresh`` gives ``node, sig`` of all sets on the minhashes of a later round; a node may repeat there. Such a round
    takes only the sets that are left: those for which the misses of all rounds so far, at the depth of their own
    longest path in each, multiply to more than 1 - ``TARGET``. A pair is parted no later than where the paths of either
    of its sets end, so it is safe as soon as one of them is.
    """
    found, left, before, runs, turn = [], None, 1.0, RUNS, 0
    while True:
        links, deep, depth = _round(sets, turn, runs, before)
        if not deep:
            return reduce(DataFrame.unionAll, found, links)
        found.append(kept(links, "candidates"))
        own = reduce(DataFrame.unionAll, deep).groupBy("node").agg(F.max("own").alias("own"))
        own = own.withColumn("miss", F.col("own")) if left is None else (
            own.join(left, "node").select("node", "own", (F.col("own") * F.col("miss")).alias("miss")))
        left = kept(own.where(F.col("miss") > 1 - TARGET).select("node", "miss"), "left")
        before = left.agg(F.max("miss").alias("m")).first().m
        if before is None:
            return reduce(DataFrame.unionAll, found)
        turn += 1
        # No more runs than the depth so far asks for.
        runs = next((r for r in range(1, RUNS) if before * missed(depth, r) <= 1 - TARGET), RUNS)
        del links, deep, own
        release(sets.sparkSession)
        some = fresh(turn).groupBy("node").agg(F.any_value("sig").alias("sig"))
        sets = kept(some.join(left.select("node"), "node", "left_semi"), "sets")


def _exact(batches):
    """Links of every set within its block or pair of blocks: how many sets and documents, and a spanning forest."""
    for table in _groups(batches, ["root", "i", "j"], 256):
        cols = {k: table.column(k).to_numpy() for k in ("root", "i", "j", "block", "node", "copies")}
        begins = _begins(cols["root"], cols["i"], cols["j"])
        shingles = table.column("shingles").combine_chunks()
        shingles = shingles.chunk(0) if isinstance(shingles, pa.ChunkedArray) else shingles
        offsets = np.asarray(shingles.offsets).astype(np.int64)
        values = np.asarray(shingles.values)
        for lo, hi in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
            n = hi - lo
            if n < 2:
                continue
            size = np.diff(offsets[lo:hi + 1])
            owner = np.repeat(np.arange(n), size)
            found, code, count = np.unique(values[offsets[lo]:offsets[hi]], return_inverse=True, return_counts=True)
            shared = count[code] > 1
            owner, code = owner[shared], (np.cumsum(count > 1) - 1)[code[shared]]
            common = np.zeros((n, n), np.float32)
            step = max(1, (8 << 20) // n)
            order = np.argsort(code, kind="stable")
            owner, code = owner[order], code[order]
            for a in range(0, int(code[-1]) + 1 if len(code) else 0, step):
                s, e = np.searchsorted(code, [a, a + step])
                presence = np.zeros((n, int(code[e - 1]) + 1 - a), np.float32)
                presence[owner[s:e], code[s:e] - a] = 1
                common += presence @ presence.T
            # Jaccard of 4 / 5 and more, in whole numbers.
            like = 9 * common >= 4 * (size[:, None] + size[None, :]).astype(np.float32)
            np.fill_diagonal(like, False)
            if cols["i"][lo] != cols["j"][lo]:  # pairs inside a block are counted elsewhere
                block = cols["block"][lo:hi]
                like &= block[:, None] != block[None, :]
            texts = like.sum(axis=1)
            a, b = np.nonzero(like)
            label = _lowest(n, a, b)
            out = np.flatnonzero(texts)
            if len(out):
                node = cols["node"][lo:hi]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[out]), pa.array(texts[out].astype(np.int64)),
                     pa.array((like @ cols["copies"][lo:hi])[out].astype(np.int64)), pa.array(node[label[out]])],
                    names=["node", "texts", "docs", "head"])


def _rare(batches):
    """The shingles by which a set meets its partners: the first fifth and one more, seldom ones of the gathering first.

    The common shingles of a gathering come ahead of the sets of each of its shards, in a row without a node.
    """
    at, known, seen = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        root, shard = batch.column("root").to_numpy(), batch.column("shard").to_numpy()
        nodes, often = batch.column("node").to_pylist(), batch.column("seen")
        offsets, values = np.asarray(batch.column("shingles").offsets), np.asarray(batch.column("shingles").values)
        buckets, owners = [], []
        for r, node in enumerate(nodes):
            if at != (root[r], shard[r]):
                at, known, seen = (root[r], shard[r]), np.zeros(0, np.int64), np.zeros(0, np.int64)
            own = values[offsets[r]:offsets[r + 1]]
            if node is None:
                known, seen = own.copy(), np.array(often[r].as_py(), np.int64)
                continue
            count = np.zeros(len(own), np.int64)
            if len(known):
                place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                count = np.where(known[place] == own, seen[place], 0)
            with np.errstate(over="ignore"):
                spread = mix(own.view(np.uint64) + np.uint64(0x2545F4914F6CDD1D))
                first = np.lexsort((own, spread, count))[:len(own) // 5 + 1]
                buckets.append(mix(spread[first] ^ mix(root[r:r + 1].view(np.uint64))).view(np.int64))
            owners.append(np.full(len(first), node, np.int64))
        if owners:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(buckets)), pa.array(np.concatenate(owners))],
                                             names=["bucket", "node"])


def split_gatherings(gathered: DataFrame, large: DataFrame) -> DataFrame:
    """``node, root``: the parts of large gatherings that may hold links; a set without a possible partner is left out.

    ``gathered``: root, node, shingles; ``large``: root, c, s (sets and shingles) of the gatherings to split. Sets go to
    one bucket for each of their rare shingles, and buckets that share sets make a part.
    """
    rows = gathered.join(large, "root").select("root", "node", "shingles", "c", "s")
    sample = rows.where(f"pmod(xxhash64(node), greatest(c div {SAMPLE_SETS}, s div {SAMPLE_SHINGLES}) + 1) = 0")
    common = (sample.select("root", F.explode("shingles").alias("v")).groupBy("root", "v").agg(F.count(F.lit(1)).alias("seen"))
              .where(F.col("seen") >= OFTEN).groupBy("root")
              .agg(F.sort_array(F.collect_list(F.struct("v", "seen"))).alias("known")))  # bounded: SAMPLE_SHINGLES / OFTEN
    shards = f"cast((c - 1) div {BLOCK_SETS} AS int) + 1"
    heads = (large.withColumn("shard", F.explode(F.expr(f"sequence(0, {shards} - 1)"))).join(common, "root")
             .select("root", "shard", F.lit(None).cast("long").alias("node"), F.col("known.v").alias("shingles"),
                     F.col("known.seen").alias("seen")))
    body = rows.selectExpr("root", f"cast(pmod(xxhash64(node, 'shard'), {shards}) AS int) AS shard", "node", "shingles",
                           "cast(null AS array<bigint>) AS seen")
    dealt = (heads.unionAll(body).repartition(shuffle_count(gathered.sparkSession), "root", "shard")
             .sortWithinPartitions("root", "shard", F.col("node").asc_nulls_first()))
    met = kept(dealt.mapInArrow(_rare, "bucket bigint, node bigint"), "rare-shingles")
    least = met.groupBy("bucket").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1")
    links = met.join(least, "bucket").selectExpr("node AS a", "head AS b")
    return components(links, "parts")


def exact_links(gathered: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, texts, docs, head`` in parts to be summed.

    ``gathered``: root, node, copies, shingles; ``wanted``: root, node, n for the same nodes, which gives the blocks.
    """
    spark = gathered.sparkSession
    blocks = (wanted.groupBy("root").agg(F.sum("n").alias("s"), F.count(F.lit(1)).alias("c"))
              .select("root", F.expr(f"cast(ceil(greatest(s / {BLOCK_SHINGLES}, c / {BLOCK_SETS})) AS int)").alias("blocks")))
    rows = gathered.join(blocks, "root").withColumn("block", F.expr("cast(pmod(xxhash64(node), blocks) AS int)"))
    # A block meets itself and every other block: pairs (i, j), i <= j, that name it.
    rows = (rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            .select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node",
                    "copies", "shingles"))
    return (rows.repartition(shuffle_count(spark), "root", "i", "j").sortWithinPartitions("root", "i", "j", "node")
            .mapInArrow(_exact, "node bigint, texts bigint, docs bigint, head bigint"))


def _shingle_rows(docs: DataFrame) -> DataFrame:
    held = Lazy(Characters)

    def work(block: pa.Table):
        codes, starts = text_codes(block.column("text"))
        values, offsets = Words(codes, starts, held()).shingles(SHINGLE)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))
        return pa.RecordBatch.from_arrays(
            [*(block.column(k).combine_chunks() for k in ("root", "node", "copies")), lists],
            names=["root", "node", "copies", "shingles"])

    return docs.select("root", "node", "copies", "text").mapInArrow(
        in_blocks(work, "text"), "root bigint, node bigint, copies bigint, shingles array<bigint>")


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables: ``doc_id, node`` of every document, and one row for each different set of shingles:
    ``node, rep, copies, class_id, class_node, n_text_links, n_links``.

    ``rep`` is the smallest id of a document with that set, ``class_id`` the smallest id of its class, which links
    of Jaccard similarity ``THRESHOLD`` or more hold together, and ``class_node`` the set of that document. Documents
    with equal sets are copies of each other. ``n_text_links`` counts linked sets, ``n_links`` linked documents,
    copies included. Documents without a word (null, empty) have a null node, are in no class and have no links.
    """
    sets = kept(sets_of(docs), "sets")
    members = sets.select("doc_id", "node")
    some = sets.where("node is not null")
    reps = kept(some.groupBy("node").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                         F.any_value("n").alias("n"), F.any_value("sig").alias("sig")), "representatives")
    release(docs.sparkSession)

    def further(turn: int) -> DataFrame:
        return sets_of(docs, turn).where("node is not null").select("node", "sig")

    gathered = components(candidate_links(reps.select("node", "sig"), further), "gatherings")
    wanted = kept(gathered.join(reps.select("node", "rep", "copies", "n"), "node"), "wanted")
    release(docs.sparkSession)
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .join(wanted.hint("shuffle_merge"), F.col("doc_id").eqNullSafe(F.col("rep"))).select("root", "node", "copies", "text"))
    if _repeats(members):  # with other texts, maybe: a row counts only if its own set is the one that is asked for
        texts = kept(texts.withColumn("own", node_of(texts)).where("own = node").drop("own").dropDuplicates(["node"]), "texts")
    shingled = _shingle_rows(texts)
    large = (wanted.groupBy("root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")).where(F.col("c") > SPLIT_SETS))
    if not large.isEmpty():
        shingled, large = kept(shingled, "shingles"), kept(large, "large")
        parts = split_gatherings(shingled, large)

        def in_parts(rows: DataFrame) -> DataFrame:
            whole = rows.join(large.select("root"), "root", "left_anti")
            cut = rows.join(large.select("root"), "root", "left_semi").drop("root").join(parts, "node")
            return whole.unionAll(cut.select(*whole.columns))

        shingled, wanted = in_parts(shingled), in_parts(wanted)
    checked = kept(exact_links(shingled, wanted), "links")
    del texts, shingled
    release(docs.sparkSession)
    sums = checked.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    roots = components(checked.selectExpr("node AS a", "head AS b"), "classes")
    info = (reps.select("node", "rep", "copies").join(roots, "node", "left").join(sums, "node", "left")
            .select("node", "rep", "copies", F.coalesce("root", "node").alias("root"),
                    F.coalesce("texts", F.lit(0)).alias("n_text_links"),
                    (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    info = kept(info, "sets-info")
    release(docs.sparkSession)
    heads = info.groupBy("root").agg(F.min_by(F.struct("rep", "node"), F.struct(F.col("rep").isNull(), "rep", "node")).alias("h"))
    return members, info.join(heads, "root").select("node", "rep", "copies", F.col("h.rep").alias("class_id"),
                                                    F.col("h.node").alias("class_node"), "n_text_links", "n_links")


def _repeats(members: DataFrame) -> bool:
    """Whether an id occurs twice."""
    return not members.groupBy("doc_id").count().where("count > 1").isEmpty()


def join_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, n_links, n_text_links`` of every document; one without words is its own class."""
    members, info = classes(docs)
    return members.join(info, "node", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"))


def one_of_each_class(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, that stand for their class: smallest id, smallest set hash of that id.

    Documents without a word all stay. Of rows that repeat id and text, one stays.
    """
    members, info = classes(docs)
    heads = info.where("node = class_node").select(F.col("node").alias("__node"), F.col("rep").alias("__rep"))
    columns = docs.columns
    tagged = docs.withColumn("__node", node_of(docs))
    silent = tagged.where("__node is null").select(*columns)
    named = tagged.where("__node is not null").join(heads, "__node").where(
        F.col("doc_id").cast("long").eqNullSafe(F.col("__rep")))
    if _repeats(members):
        named = named.dropDuplicates(["__node"])
    return named.select(*columns).unionAll(silent)


ship(__name__)
