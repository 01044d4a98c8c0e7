"""Best-fit packing of documents into sequences of several permitted lengths.

Pieces go by falling length into the open sequence with the least room that still takes them. If none does, a new one
is opened with the permitted length that costs least per unit it can be expected to hold. In the end every sequence is
cut down to the smallest permitted length that holds its contents. Which lengths may be opened is tried out jointly: each ceiling on them is
packed, and the cheapest outcome stays. Documents are dealt evenly over shards of bounded size, packed one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship

CAPACITIES = (1024, 2048, 4096, 8192, 16384, 32768)
# Cost of a sequence beside its length: a constant, and attention that grows with the square.
COST_FIXED, COST_SQUARE = 64.0, 1 / 262144
# Documents of one shard, on average.
SHARD_ROWS = 50_000

PIECES = ("doc_id bigint, piece int, start bigint, length bigint, bin_id bigint, place int, offset bigint, used bigint, "
          "capacity bigint")


def cost(capacity):
    return capacity + COST_FIXED + COST_SQUARE * capacity * capacity


def pack(lengths: np.ndarray, capacities: tuple[int, ...]) -> tuple[np.ndarray, float]:
    """Sequence number of each length (already falling, none above the largest capacity), and the cost in all."""
    top = capacities[-1]
    costs = [cost(c) for c in capacities]
    at_room: list[list[int]] = [[] for _ in range(top + 1)]
    rooms = 0  # bit r: some open sequence has room r
    held: list[int] = []
    out = np.zeros(len(lengths), np.int64)
    rest = int(lengths.sum())
    for i, n in enumerate(lengths.tolist()):
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = at_room[room].pop()
            if not at_room[room]:
                rooms &= ~(1 << room)
        else:
            best = min((k for k, c in enumerate(capacities) if c >= n), key=lambda k: (costs[k] / min(capacities[k], rest), k))
            room, b = capacities[best], len(held)
            held.append(0)
        held[b] += n
        rest -= n
        out[i] = b
        if room > n:
            at_room[room - n].append(b)
            rooms |= 1 << (room - n)
    used = np.array(held, np.int64)
    fitted = np.array(capacities)[np.searchsorted(capacities, used)] if len(used) else used
    return out, float(cost(fitted).sum())


def pack_jointly(lengths: np.ndarray, capacities: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence of each length, and contents and downsized length of each sequence."""
    longest = int(lengths[0]) if len(lengths) else 0
    tried = [pack(lengths, capacities[:k + 1]) for k in range(len(capacities)) if capacities[k] >= longest]
    chosen = min(tried, key=lambda x: x[1])[0]
    used = np.bincount(chosen, weights=lengths).astype(np.int64) if len(lengths) else np.zeros(0, np.int64)
    return chosen, used, np.array(capacities)[np.searchsorted(capacities, used)]


def pack_documents(docs: DataFrame, length: Column, capacities: tuple[int, ...] = CAPACITIES, id_column: str = "doc_id",
                   shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row a piece: document, place in it, sequence, place and offset in the sequence, its contents and length.

    A document longer than the largest capacity is cut into pieces of it and a rest. Null or negative lengths count as
    0; a document of length 0 is one empty piece, put into some sequence. Repeated rows and null ids are pieces of
    their own. An empty table gives no rows. ``bin_id`` is unique over shards.
    """
    capacities = tuple(sorted(set(capacities)))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).alias("length"))
    shards = max(1, -(-rows.count() // shard_rows))

    def shard(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        docs_of, lengths = table.column("doc_id"), table.column("length").to_numpy()
        top = capacities[-1]
        pieces = np.maximum(1, -(-lengths // top))
        owner = np.repeat(np.arange(len(lengths)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.minimum(top, lengths[owner] - nth * top)
        ids = np.nan_to_num(docs_of.to_numpy().astype(float), nan=-1.0)[owner] if docs_of.null_count else docs_of.to_numpy()[owner]
        order = np.lexsort((nth, ids, -size))
        owner, nth, size = owner[order], nth[order], size[order]
        chosen, used, fitted = pack_jointly(size, capacities)
        by = np.argsort(chosen, kind="stable")
        first = np.concatenate([[True], chosen[by][1:] != chosen[by][:-1]])
        begin = np.flatnonzero(first)
        of = np.cumsum(first) - 1
        before = np.cumsum(size[by]) - size[by]
        place, offset = np.zeros(len(by), np.int64), np.zeros(len(by), np.int64)
        place[by] = np.arange(len(by)) - begin[of]
        offset[by] = before - before[begin[of]]
        bins = chosen + (TaskContext.get().partitionId() << 32)
        columns = [docs_of.take(pa.array(owner)).combine_chunks(), pa.array(nth, pa.int32()), pa.array(nth * top), pa.array(size),
                   pa.array(bins), pa.array(place, pa.int32()), pa.array(offset), pa.array(used[chosen]), pa.array(fitted[chosen])]
        yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in PIECES.split(", ")])

    return rows.repartition(shards).mapInArrow(shard, PIECES)


ship(__name__)
