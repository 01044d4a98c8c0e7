"""Grouped aggregates. Lists are only built where the list is the result, and then in bounded parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import bind, bucket_millis
from tidemark.plans.ordering import list_parts, range_chunks, running_sum

# Window of the record job, and the largest id set written out in full.
RECORD_WINDOW_MS = 300_000
LABEL_LIMIT = 5
MIB = 1024.0 * 1024.0

LIST_ROWS = 100_000


def word_count(words: DataFrame, word: str = "word") -> DataFrame:
    return words.groupBy(word).agg(F.count(F.lit(1)).alias("count"))


def set_text(ids: Column) -> Column:
    return F.concat(F.lit("Set("), F.array_join(F.array_sort(ids), ", ", "null"), F.lit(")"))


def distinct_label(n: Column, ids: Column) -> Column:
    """More than five ids: their number as text, else the sorted set as text."""
    return F.when(n > LABEL_LIMIT, n.cast("string")).otherwise(set_text(ids))


def labelled_sums(df: DataFrame, group: list[str], point: str, value: str) -> DataFrame:
    """Count, sum, mean and id label per group; group columns and ids are not null.

    Rows collapse to one per group and id first. The label needs at most five ids, so
    the rank filter keeps five per task before the shuffle; no id set is ever collected.
    """
    pairs = df.groupBy(*group, point).agg(F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__s"))
    totals = pairs.groupBy(*group).agg(
        F.sum("__n").alias("count"), F.sum("__s").alias("sum"), F.count(F.lit(1)).alias("__points"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(point))
    # The sums stay in the rows, so that both branches read the same exchange of pairs.
    ids = (
        pairs.withColumn("__rank", rank).where(F.col("__rank") <= LABEL_LIMIT)
        .groupBy(*group).agg(F.collect_list(F.struct(F.col(point).alias("id"), "__n", "__s")).alias("__five"))
        .select(*group, F.transform("__five", lambda r: r["id"]).alias("__ids"))
    )
    return totals.join(ids, group).select(
        *group, "count", "sum", (F.col("sum") / F.col("count")).alias("avg"),
        distinct_label(F.col("__points"), F.col("__ids")).alias("points"))


def tumbling_records(records: DataFrame, width_ms: int = RECORD_WINDOW_MS) -> DataFrame:
    """Per time bucket: (start, count, sum, avg, points). Rows without time, value or point are dropped."""
    usable = records.where(F.col("time").isNotNull() & F.col("value").isNotNull() & F.col("pointId").isNotNull())
    return labelled_sums(usable.withColumn("start", bucket_millis(F.col("time"), width_ms)),
                         ["start"], "pointId", "value")


def by_point(records: DataFrame) -> DataFrame:
    """The same figures per point; a null point is a group, null values are dropped."""
    return (
        records.where(F.col("value").isNotNull()).groupBy("pointId")
        .agg(F.count(F.lit(1)).alias("count"), F.sum("value").alias("sum"), F.avg("value").alias("avg"))
        .withColumn("points", set_text(F.array("pointId")))
    )


def partial_counts(df: DataFrame, window: Column, partition: Column | None = None) -> DataFrame:
    """Rows per partition and window; without a column, per task partition, with no shuffle before it."""
    index = F.spark_partition_id() if partition is None else partition
    return df.groupBy(index.alias("partition"), window.alias("start")).agg(F.count(F.lit(1)).alias("count"))


def partition_local_groups(df: DataFrame, key: str, partition: str = "partition") -> DataFrame:
    """Rows per partition and key; a key shows once in every partition that holds it."""
    return df.groupBy(partition, key).agg(F.count(F.lit(1)).alias("count"))


def time_value_items(df: DataFrame, window: str, value: str) -> Column:
    """Item text of the partition-local groups."""
    return F.concat(F.lit("time:"), F.col(window).cast("string"), F.lit(", value="), F.col(value).cast("string"))


def partition_profile(df: DataFrame, partition: str, point: str, list_rows: int = LIST_ROWS) -> DataFrame:
    """Per partition: rows, distinct points, and the sorted point ids in parts of about ``list_rows``."""
    pairs = df.groupBy(partition, point).agg(F.count(F.lit(1)).alias("__n"))
    totals = pairs.groupBy(partition).agg(F.sum("__n").alias("rows"), F.count(F.lit(1)).alias("points"))
    lists = (
        list_parts(pairs.select(partition, point), [partition], point, list_rows)
        .groupBy(partition, "part").agg(F.sort_array(F.collect_list(point)).alias("ids"))
    )
    return totals.join(lists, partition)


def partition_counts(log: DataFrame) -> DataFrame:
    """Records per partition and the total of the topic (the window sees one row per partition)."""
    counts = log.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("total", F.sum("count").over(Window.partitionBy("topic")))


def offset_summary(log: DataFrame, payload: str = "value", offsets_unique: bool = False) -> DataFrame:
    """Kept offsets per partition: number, least and greatest.

    Kept are JSON payloads with a ``value`` field and texts that are no JSON. An offset counts
    once; where the log holds none twice, ``offsets_unique`` saves the shuffle that sees to it.
    """
    kept = bind(F.try_parse_json(F.col(payload).cast("string")),
                lambda parsed: parsed.isNull() | F.try_variant_get(parsed, "$.value", "variant").isNotNull())
    rows = log.select("partition", "offset", F.when(kept, 1).otherwise(0).alias("kept"))
    if not offsets_unique:
        rows = rows.groupBy("partition", "offset").agg(F.max("kept").alias("kept"))
    place = F.when(F.col("kept") == 1, F.col("offset"))
    return rows.groupBy("partition").agg(
        F.sum("kept").alias("size"), F.min(place).alias("min_offset"), F.max(place).alias("max_offset"))


def poll_summary(log: DataFrame, poll_rows: int) -> DataFrame:
    """Per partition and poll of ``poll_rows`` offsets: size, first and last offset."""
    return (
        log.groupBy("topic", "partition", F.expr(f"offset div {int(poll_rows)}").alias("poll"))
        .agg(F.count(F.lit(1)).alias("size"), F.min("offset").alias("first"), F.max("offset").alias("last"))
    )


def second_bucket_lists(df: DataFrame, timestamp: str, order: str, item: str, size: Column,
                        list_rows: int = LIST_ROWS) -> DataFrame:
    """Per second: its size sum and the records in order, in parts of at most ``list_rows`` ids."""
    rows = df.select(F.date_trunc("second", timestamp).alias("second"), F.col(order).alias("__order"),
                     F.col(item).alias("__item"), size.alias("__size"))
    parts = rows.groupBy("second", F.expr(f"__order div {int(list_rows)}").alias("part")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("__order", "__item"))), lambda r: r["__item"]).alias("records"),
        F.sum("__size").alias("part_size"))
    totals = rows.groupBy("second").agg(F.sum("__size").alias("size"))
    return parts.join(totals, "second").select("second", "part", "records", "part_size", "size")


def group_lengths(df: DataFrame, key: str) -> DataFrame:
    """Length of the list of equal items: counted, never built."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("length"))


def adjacency(edges: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """Distinct neighbours per node, in parts of about ``list_rows``."""
    return (
        list_parts(distinct_rows(edges.select("src", "dst")), ["src"], "dst", list_rows)
        .groupBy("src", "part").agg(F.sort_array(F.collect_list("dst")).alias("neighbours"))
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def _bytes(column: str) -> Column:
    return F.coalesce(F.octet_length(column), F.lit(0))


def throughput_total(log: DataFrame, elapsed_ms: Column | None = None, group: list[str] | None = None) -> DataFrame:
    """Messages, bytes, MB and both per second; the time is given or spans first to last row."""
    span = F.max(F.unix_millis("timestamp")) - F.min(F.unix_millis("timestamp")) if elapsed_ms is None else elapsed_ms
    sums = log.groupBy(*(group or [])).agg(
        F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(_bytes("key") + _bytes("value")), F.lit(0)).alias("bytes"), span.alias("elapsed_ms"))
    seconds = F.nullif(F.col("elapsed_ms"), F.lit(0)) / F.lit(1000.0)
    mb = F.col("bytes") / F.lit(MIB)
    return sums.select(
        *(group or []), "messages", "bytes", "elapsed_ms", mb.alias("mb"),
        F.coalesce(mb / seconds, F.lit(0.0)).alias("mb_per_s"),
        F.coalesce(F.col("messages") / seconds, F.lit(0.0)).alias("messages_per_s"))


def throughput_report(df: DataFrame, time_ms: Column, latency: str, size: Column, interval_ms: int,
                      group: list[str] | None = None) -> DataFrame:
    """Count, rate, mean and greatest latency and MB/s per reporting interval of event time."""
    keys = list(group or [])
    rows = df.select(*keys, bucket_millis(time_ms, interval_ms).alias("start"), F.col(latency).alias("__latency"),
                     size.alias("__size"))
    seconds = interval_ms / 1000.0
    return rows.groupBy(*keys, "start").agg(
        F.count(F.lit(1)).alias("count"), (F.count(F.lit(1)) / F.lit(seconds)).alias("per_s"),
        F.avg("__latency").alias("mean_latency"), F.max("__latency").alias("max_latency"),
        (F.sum("__size") / F.lit(MIB) / F.lit(seconds)).alias("mb_per_s"))


def nearest_rank(df: DataFrame, keys: list[str], value: str,
                 shares: tuple[float, ...] = (0.5, 0.95, 0.99, 0.999), partitions: int | None = None) -> DataFrame:
    """Exact percentiles per key: the sorted element at position ``int(p * n)``.

    Equal values collapse to one row with a count, so no value is too hot to place in the
    order; the counts are then summed along range chunks, each of them one task.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    chunked = range_chunks(counts, [*keys, value], "__part", partitions)
    ranked = running_sum(chunked, keys, value, "__n", "__part", "__to")
    sizes = chunked.groupBy(*keys).agg(F.sum("__n").alias("__size"))
    wanted = sizes.select(*keys, F.explode(F.array(*map(F.lit, shares))).alias("p"), "__size").withColumn(
        "__at", F.floor(F.col("p") * F.col("__size")))
    # One row per key with its few positions: compared in place, so each value row is read once.
    positions = wanted.groupBy(*keys).agg(F.collect_list(F.struct("p", "__at")).alias("__wanted"))
    return (
        ranked.join(positions, keys)
        .withColumn("__hit", F.explode(F.filter("__wanted", lambda w: (w["__at"] < F.col("__to")) &
                                                (w["__at"] >= F.col("__to") - F.col("__n")))))
        .select(*keys, F.col("__hit.p").alias("p"), F.col(value).alias("value"))
    )


def constant_bin(x: Column, bins: int, low: float, high: float) -> Column:
    """Bin 0 lies below ``low``, the last above ``high``; equal widths between."""
    if bins < 2:
        raise ValueError("at least 2 bins")
    if bins == 2:
        return F.when(x < low, F.lit(0)).otherwise(F.lit(1))
    width = (high - low) / (bins - 2)
    return F.when(x < low, F.lit(0)).when(x > high, F.lit(bins - 1)).otherwise(
        F.floor((x - F.lit(low)) / F.lit(width)).cast("int") + 1)


def constant_bin_edge(b: Column, bins: int, low: float, high: float) -> Column:
    """Lower edge of a bin; the two end bins are infinite."""
    width = (high - low) / max(bins - 2, 1)
    return (F.when(b == 0, F.lit(float("-inf"))).when(b == bins - 1, F.lit(float("inf")))
            .otherwise(F.lit(low) + (b - 1) * F.lit(width)))


def linear_bin(x: Column, bins: int, high: float) -> Column:
    """Bins that widen by one step each; a negative value raises, one above ``high`` is in the last bin."""
    scale = high / (bins * (bins - 1) // 2)
    inside = F.floor(F.lit(-0.5) + F.sqrt(F.lit(2.0) * (x / F.lit(scale)) + F.lit(0.25))).cast("int")
    return (F.when(x < 0, F.raise_error(F.lit("negative value in a linear histogram")).cast("int"))
            .when(x > high, F.lit(bins - 1)).otherwise(inside))


def histogram(df: DataFrame, keys: list[str], bin_column: Column) -> DataFrame:
    return df.groupBy(*keys, bin_column.alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def linear_bin_edge(number: Column, bins: int, high: float) -> Column:
    """Lower edge of a bin whose width grows by the same amount from bin to bin; the last bin stands for infinity."""
    unit = high / (bins * (bins - 1) // 2)
    return F.when(number == bins - 1, F.lit(float("inf"))).otherwise(number * (number + 1) / F.lit(2.0) * F.lit(unit))


def histogram_quantile(bins_table: DataFrame, keys: list[str], q: float, bins: int, low: float,
                       high: float, linear: bool = False) -> DataFrame:
    """Edge of the first bin whose cumulative share is above ``q``; keys have at most ``bins`` rows each.

    ``linear`` is for bins of ``linear_bin``, which start at 0, so ``low`` does not count.
    """
    edge = linear_bin_edge(F.col("bin"), bins, high) if linear else constant_bin_edge(F.col("bin"), bins, low, high)
    upto = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(*keys)
    shares = bins_table.select(*keys, "bin", (F.sum("count").over(upto) / F.sum("count").over(every)).alias("share"))
    found = shares.groupBy(*keys).agg(
        F.min(F.when(F.col("share") > q, F.col("bin"))).alias("bin"), F.max("share").alias("__any"))
    return found.select(
        *keys,
        F.when(F.col("__any").isNull(), F.lit(float("nan")))
        .otherwise(F.coalesce(edge, F.lit(float("inf")))).alias("value"))


def retention_summary(log: DataFrame, keep: Column, group: list[str], payload: str = "value") -> DataFrame:
    """Rows and payload bytes read and kept; greatest kept offset and time, and the offset of that time."""
    size = _bytes(payload).cast("long")
    time_ms = F.unix_millis("timestamp")
    place = F.lit("1" + "0" * 19).cast("decimal(20,0)")
    kept = F.coalesce(keep, F.lit(False))
    return log.groupBy(*group).agg(
        F.count(F.lit(1)).alias("messages_read"), F.sum(size).alias("bytes_read"),
        F.count_if(kept).alias("messages_retained"),
        F.sum(F.when(kept, size).otherwise(F.lit(0))).alias("bytes_retained"),
        F.coalesce(F.max(F.when(kept, F.col("offset"))), F.lit(-1)).alias("max_offset"),
        F.coalesce(F.max(F.when(kept, time_ms)), F.lit(-1)).alias("max_timestamp"),
        # Of several rows with the greatest time the first one counts. Time and offset share one
        # number, which a hash aggregate can hold; a struct would need the rows sorted.
        F.max(F.when(kept, time_ms.cast("decimal(18,0)") * place - F.col("offset"))).alias("__last"),
    ).select("*", F.coalesce(
        (F.col("max_timestamp").cast("decimal(18,0)") * place - F.col("__last")).cast("long"), F.lit(-1)).alias("offset_of_max_timestamp")).drop("__last")


def topic_partitions(log: DataFrame) -> DataFrame:
    """Partitions per topic: number and sorted list (one entry per partition, so small)."""
    return log.select("topic", "partition").distinct().groupBy("topic").agg(
        F.count(F.lit(1)).alias("partitions"), F.sort_array(F.collect_list("partition")).alias("ids"))
