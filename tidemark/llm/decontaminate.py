"""Benchmark passages in documents, by the q-gram lemma.

A passage of m characters that occurs with at most e edits shares at least m + 1 - q (e + 1) of its q-grams with the
text, all on e + 1 neighbouring diagonals. Shared q-grams are counted in bands of 2 (e + 1) diagonals that overlap by
half, so that some band holds them all; bands that reach the bound are aligned within the band, and those within the
edit budget are reported. Case, punctuation and spacing do not count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Characters, Lazy, mix, ship, small_batches, text_codes, text_udf

Q = 8
BUDGET = 0.1  # edits per character of a passage
# Passages under so many characters prove nothing and take no part; longer ones than that are looked for in pieces.
LEAST, MOST = 24, 1024
# Characters of benchmark that go out together; more are worked off in further blocks.
BLOCK_CHARS = 2 << 20
FILTER_BITS = 23
# Shared q-grams that are counted together.
PART = 4 << 20

HITS = "array<struct<item_id:bigint,edits:int,begin:bigint,end:bigint>>"


def normal(codes: np.ndarray, starts: np.ndarray, chars: Characters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded letters and digits with one space for all else; starts of texts in it; old place of every character."""
    chars.learn(codes)
    inside = chars.word[codes]
    folded = np.where(inside, chars.fold[codes], np.uint32(32))
    first = np.zeros(len(codes), bool)
    first[starts[:-1][starts[:-1] < len(codes)]] = True
    keep = inside | (np.concatenate([[False], inside[:-1]])[:len(codes)] & ~first)
    places = np.flatnonzero(keep)
    return folded[places], np.searchsorted(places, starts), places


def grams(codes: np.ndarray) -> np.ndarray:
    """Hash of the ``Q`` = 8 characters from every place on."""
    h = codes.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        for width, base in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (4, 0x165667B19E3779F9)):
            h = h[:-width] * np.uint64(base) + h[width:] if len(h) > width else h[:0]
        return mix(h)


class Passages:
    """The passages of one block, with an index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        codes, starts = text_codes(pa.array([t for _, t in items], pa.string()))
        codes, starts, _ = normal(codes, starts, Characters())
        self.item, self.text = [], []
        for (item, _), a, b in zip(items, starts[:-1], starts[1:], strict=True):
            own = codes[a:b]
            own = own[:-1] if len(own) and own[-1] == 32 else own
            pieces = max(1, -(-len(own) // MOST))
            for k in range(pieces):
                part = own[len(own) * k // pieces:len(own) * (k + 1) // pieces]
                if len(part) >= LEAST:
                    self.item.append(item)
                    self.text.append(part)
        m = np.array([len(t) for t in self.text], np.int64)
        self.length = m
        self.budget = np.minimum((BUDGET * m).astype(np.int64), m // Q - 1)
        self.bound = m + 1 - Q * (self.budget + 1)
        found = [grams(t) for t in self.text]
        hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
        place = np.concatenate([np.arange(len(x)) for x in found]) if found else np.zeros(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        self.gram, first = np.unique(hashes[order], return_index=True)
        self.first = np.concatenate([first, [len(hashes)]])
        self.owner, self.place = owner[order], place[order]
        self.present = np.zeros(1 << FILTER_BITS, bool)
        self.present[(self.gram >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def search(self, texts: pa.Array, chars: Characters) -> list[list[dict]]:
        raw, raw_starts = text_codes(texts)
        codes, starts, places = normal(raw, raw_starts, chars)
        n = len(starts) - 1
        out: list[list[dict]] = [[] for _ in range(n)]
        if not len(self.item) or len(codes) < Q:
            return out
        h = grams(codes)
        at = np.flatnonzero(self.present[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        which = np.minimum(np.searchsorted(self.gram, h[at]), len(self.gram) - 1)
        at, which = at[self.gram[which] == h[at]], which[self.gram[which] == h[at]]
        doc = np.searchsorted(starts, at, side="right") - 1
        whole = at + Q <= starts[doc + 1]
        at, which, doc = at[whole], which[whole], doc[whole]
        keys, counts = self.bands(at, which, doc, starts)
        # A band of double width holds the diagonals of its own step and those of the next.
        next_at = np.minimum(np.searchsorted(keys, keys + 1), len(keys) - 1) if len(keys) else keys
        both = counts + np.where(keys[next_at] == keys + 1, counts[next_at], 0) if len(keys) else counts
        # The band before an isolated step holds no more than that step does, so it needs no look of its own.
        good = keys[both >= self.bound[(keys >> 28) & 0xFFFF]]
        if not len(good):
            return out
        doc, passage = good >> 44, (good >> 28) & 0xFFFF
        low = (good & 0xFFFFFFF) * (self.budget[passage] + 1) - MOST
        best: dict[tuple[int, int], tuple] = {}
        for a in range(0, len(good), 2048):  # bounds the matrices
            some = slice(a, a + 2048)
            edits, end = self.align(codes, starts, doc[some], passage[some], low[some])
            for d, p, e, first, last in zip(doc[some], passage[some], edits, low[some], end, strict=True):
                if e <= self.budget[p]:
                    begin = starts[d] + max(0, int(first) - int(self.budget[p]))
                    last = min(int(last), int(starts[d + 1])) - 1
                    found = (int(e), int(places[begin] - raw_starts[d]), int(places[max(last, begin)] - raw_starts[d] + 1))
                    who = (int(d), self.item[p])
                    best[who] = min(best.get(who, found), found)
        for (d, item), (e, begin, end) in sorted(best.items()):
            out[d].append({"item_id": item, "edits": e, "begin": begin, "end": end})
        return out

    def bands(self, at: np.ndarray, which: np.ndarray, doc: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shared q-grams in each step of diagonals of each text and passage, counted in parts of bounded size."""
        count = self.first[which + 1] - self.first[which]
        upto = np.cumsum(count)
        keys, sums, a = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        while a < len(at):
            before = int(upto[a - 1]) if a else 0
            b = max(a + 1, int(np.searchsorted(upto, before + PART, side="right")))
            n = count[a:b]
            total = int(upto[b - 1]) - before
            # One entry for every occurrence of the q-gram in a passage.
            entry = np.repeat(self.first[which[a:b]] - (upto[a:b] - before - n), n) + np.arange(total)
            owner = self.owner[entry]
            band = (np.repeat(at[a:b] - starts[doc[a:b]], n) - self.place[entry] + MOST) // (self.budget[owner] + 1)
            more, c = np.unique((np.repeat(doc[a:b], n) << 44) | (owner << 28) | band, return_counts=True)
            keys, back = np.unique(np.concatenate([keys, more]), return_inverse=True)
            sums = np.bincount(back, np.concatenate([sums, c])).astype(np.int64)
            a = b
        return keys, sums

    def align(self, codes, starts, doc, passage, low) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of each passage within its band, the text's ends being free, and where it ends."""
        m, e = self.length[passage], self.budget[passage]
        width = int((4 * e + 4).max())
        rows = int(m.max())
        pattern = np.zeros((len(doc), rows), np.uint32)
        for i, p in enumerate(passage):
            pattern[i, :m[i]] = self.text[p]
        base = starts[doc] + low - e
        shift = np.arange(width)
        cost = np.zeros((len(doc), width), np.int32)
        final, end = np.full(len(doc), np.iinfo(np.int32).max), np.zeros(len(doc), np.int64)
        live = np.arange(len(doc))
        for j in range(rows):
            place = base[live, None] + j + shift
            outside = (place < starts[doc[live], None]) | (place >= starts[doc[live] + 1, None])
            same = (codes[np.clip(place, 0, len(codes) - 1)] == pattern[live, j][:, None]) & ~outside
            moved = cost + ~same
            moved[:, :-1] = np.minimum(moved[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(moved - shift, axis=1) + shift
            done = m[live] == j + 1
            if done.any():
                w = cost[done].argmin(axis=1)
                final[live[done]] = cost[done][np.arange(len(w)), w]
                end[live[done]] = base[live[done]] + j + w + 1
                cost, live = cost[~done], live[~done]
        return final.astype(np.int64), end


def passage_blocks(benchmark: DataFrame, item_column: str, text_column: str) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of about ``BLOCK_CHARS``, one after the other; at most 60 000 passages in each."""
    rows = (benchmark.select(F.col(item_column).cast("long").alias("item"), F.col(text_column).cast("string").alias("text"))
            .where("item is not null and text is not null").distinct())
    total = rows.agg(F.sum(F.length("text")).alias("c"), F.count(F.lit(1)).alias("n")).first()
    blocks = max(-(-(total.c or 0) // BLOCK_CHARS), -(-total.n // 30_000), 1)
    for b in range(blocks):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
               .orderBy("item", "text").collect()]


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_column: str = "item_id",
            text_column: str = "text") -> Column:
    """For each text of ``docs``, the benchmark items in it: ``item_id, edits, begin, end`` (code points, end exclusive).

    ``begin`` and ``end`` bound a region that holds the passage. Of several occurrences of an item in a text, that with
    the fewest edits is given. Null and empty texts have none; benchmark rows without id or text, and passages shorter
    than ``LEAST`` normalised characters, take no part; an empty benchmark matches nothing.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("begin", pa.int64()), ("end", pa.int64())]))
    found = []
    for items in passage_blocks(benchmark, item_column, text_column):
        sent = spark.sparkContext.broadcast(vars(Passages(items)))  # bounded: BLOCK_CHARS
        found.append(text_udf(_searcher(sent, kind), HITS)(F.col(text).cast("string")))
    if len(found) == 1:
        return found[0]
    # Texts of one item may be in several blocks: sorted by item and edits, the first of each item stays.
    return F.aggregate(F.array_sort(F.concat(*found)), F.array().cast(HITS), lambda a, x: F.when(
        (F.size(a) > 0) & (F.try_element_at(a, F.lit(-1)).item_id == x.item_id), a).otherwise(F.concat(a, F.array(x))))


def _searcher(sent, kind):
    chars = Lazy(Characters)

    def work(texts):
        passages = Passages.__new__(Passages)
        vars(passages).update(sent.value)
        return pa.array(passages.search(texts, chars()), kind)

    return work


ship(__name__)
