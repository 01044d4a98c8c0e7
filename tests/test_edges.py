"""Edge rows with known results."""

import math
import struct
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import binary, partitioner, scalar, typed
from tidemark.functions.draws import draw, draw_int
from tidemark.operators import aggregates as A
from tidemark.operators import generate, graph, joins, limits, monitor, positions, records, transforms, windows
from tidemark.plans import views
from tidemark.sources import files
from tidemark.sources import log as L


def test_split_java(spark):
    df = spark.createDataFrame([("",), (" ",), ("a",), (" a",), ("a  b  ",)], "s string")
    assert [r[0] for r in df.select(scalar.split_java(F.col("s"))).collect()] == [
        [""], [], ["a"], ["", "a"], ["a", "", "b"]]


def test_split_whitespace_raises_on_one_field(spark):
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        spark.createDataFrame([("a",)], "s string").select(scalar.split_whitespace(F.col("s"))).collect()


def test_bucket_millis_goes_toward_zero(spark):
    df = spark.createDataFrame([(-1,), (-300001,), (299999,)], "t bigint")
    assert [r[0] for r in df.select(scalar.bucket_millis(F.col("t"), 300000)).collect()] == [0, -300000, 0]


def test_rates(spark):
    one = spark.range(1)
    got = one.select(scalar.rate_per_second(F.lit(100), F.lit(3000), 2), scalar.rate_per_second(F.lit(100), F.lit(0), 2),
                     scalar.rate_ten_thousands(F.lit(12350.0))).first()
    assert tuple(got) == (33.33, 0.0, 1.24)


def test_numeric_value_and_parse(spark, rows):
    texts = ['{"value":1.5}', '{"value":5}', '{"value":"1.5"}', '{"value":true}', '{"value":null}', "{}", "{bad"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert rows(records.numeric_values(df)) == [(texts[0],), (texts[1],)]
    assert records.valid_json(df).count() == 6
    assert rows(records.records(df), "value") == [(1.5,), (5.0,), (None,), (None,)]


def test_asset_time_value_drops_nulls(spark, rows):
    texts = ['{"time":1000,"value":null,"assetId":"a"}', '{"value":2,"assetId":"a"}', '{"time":1000,"value":2}',
             '{"time":1000,"value":2,"assetId":"a"}']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert rows(records.time_value(df, with_asset=True)) == [("a", datetime(1970, 1, 1, 0, 0, 1), 2.0)]
    assert records.time_value(df).count() == 2


def test_tumbling_and_label(spark, rows):
    df = spark.createDataFrame(
        [(0, "a", 1.0), (299999, "b", 3.0), (300000, "a", 5.0), (1, None, 9.0), (2, "c", None), (None, "a", 1.0)],
        "time bigint, pointId string, value double")
    assert rows(A.tumbling_records(df)) == [(0, 2, 4.0, 2.0, "Set(a, b)"), (300000, 1, 5.0, 5.0, "Set(a)")]
    many = spark.range(1000).selectExpr("id % 2 AS g", "concat('p', id % IF(id % 2 = 0, 12, 10)) AS p", "1D AS v")
    assert rows(A.labelled_sums(many, ["g"], "p", "v"), "g", "count", "points") == [
        (0, 500, "6"), (1, 500, "Set(p1, p3, p5, p7, p9)")]
    assert rows(A.by_point(df), "pointId", "points")[-1] == (None, "Set(null)")


def test_missing_keys_and_values(spark):
    df = spark.createDataFrame([(None,), ("k",)], "k string")
    assert [tuple(r) for r in df.select(records.default_key(F.col("k")), records.null_literal(F.col("k"))).collect()] == [
        ("UNKNOWN_PARTITION", "NULL"), ("k", "k")]


def test_parse_int_or_zero(spark):
    df = spark.createDataFrame([(t,) for t in ("7", "x", None, "1.5", " 7", "-3", "99999999999")], "t string")
    assert [r[0] for r in df.select(scalar.parse_int_or_zero(F.col("t"))).collect()] == [7, 0, 0, 0, 0, -3, 0]


def test_topic_pattern_is_a_full_match(spark, rows):
    df = spark.createDataFrame([("testA",), ("mytest",)], "topic string")
    assert rows(df.where(L.topic_matches(F.col("topic"), "test.*"))) == [("testA",)]


def test_attributes(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"},), (None,)], "attr map<string,string>")
    got = [r[0] for r in records.with_attributes(df, {"b": "9", "n": F.lit(4)}).select("attr").collect()]
    assert got == [{"a": "1", "b": "9", "n": "4"}, {"b": "9", "n": "4"}]
    assert records.with_attributes(spark.range(1), {"x": "y"}).first()["attr"] == {"x": "y"}


def test_headers(spark):
    df = spark.sql("""SELECT array(named_struct('key', 'a', 'value', X'31'), named_struct('key', 'a', 'value', X'32')) AS h
                      UNION ALL SELECT NULL""")
    got = df.select(F.decode(records.last_header(F.col("h"), "a"), "UTF-8"), records.last_header(F.col("h"), "b"),
                    records.header_equals(F.col("h"), "a", "1")).collect()
    assert [tuple(r) for r in got] == [("2", None, True), (None, None, False)]


def test_offset_summary(spark, rows):
    df = spark.createDataFrame([(0, 0, '{"value":1}'), (0, 1, '{"x":1}'), (0, 2, "not json"), (1, 0, "{}"), (0, 0, '{"value":1}')],
                               "partition int, offset bigint, value string")
    assert rows(A.offset_summary(df)) == [(0, 2, 0, 2), (1, 0, None, None)]


def test_nearest_rank(spark, rows):
    df = spark.range(100).selectExpr("1 AS k", "id AS v")
    assert rows(A.nearest_rank(df, ["k"], "v"), "p", "value") == [(0.5, 50), (0.95, 95), (0.99, 99), (0.999, 99)]


def test_histograms(spark, rows):
    x = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 4.9, 5.0, 10.0, 11.0)], "x double")
    assert [r[0] for r in x.select(A.constant_bin(F.col("x"), 4, 0.0, 10.0)).collect()] == [0, 1, 1, 2, 3, 3]
    y = spark.createDataFrame([(v,) for v in (0.0, 1.0, 2.0, 3.0, 6.0, 7.0)], "x double")
    assert [r[0] for r in y.select(A.linear_bin(F.col("x"), 4, 6.0)).collect()] == [0, 1, 1, 2, 3, 3]
    with pytest.raises(Exception, match="negative"):
        x.select(A.linear_bin(F.col("x"), 4, 6.0)).collect()
    with pytest.raises(ValueError):
        A.constant_bin(F.col("x"), 1, 0.0, 1.0)
    bins = A.histogram(x.withColumn("k", F.lit(1)), ["k"], A.constant_bin(F.col("x"), 4, 0.0, 10.0))
    assert rows(A.histogram_quantile(bins, ["k"], 0.4, 4, 0.0, 10.0), "value") == [(0.0,)]
    assert rows(A.histogram_quantile(bins, ["k"], 0.99, 4, 0.0, 10.0), "value") == [(math.inf,)]
    assert rows(A.histogram_quantile(bins, ["k"], 0.1, 4, 0.0, 10.0), "value") == [(-math.inf,)]
    bins = A.histogram(y.withColumn("k", F.lit(1)), ["k"], A.linear_bin(F.col("x"), 4, 6.0))
    got = [rows(A.histogram_quantile(bins, ["k"], q, 4, 0.0, 6.0, linear=True), "value")[0][0] for q in (0.1, 0.4, 0.6, 0.9)]
    assert got == [0.0, 1.0, 3.0, math.inf]


def test_moving_average(spark, rows):
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate((1, 2, 3, 4))], "s string, i bigint, v double")
    assert rows(windows.moving_average(df, ["s"], "i", "v", 2), "i", "mean") == [(0, 1.0), (1, 1.5), (2, 2.0), (3, 3.0)]
    hundred = spark.range(100).selectExpr("'s' AS s", "id AS i", "cast(id AS double) AS v")
    assert dict(rows(windows.moving_average(hundred, ["s"], "i", "v", 5), "i", "mean"))[99] == 96.5
    assert rows(windows.warmup_skip(df, ["s"], "i", "v", 2, 1), "i", "mean") == [(0, 0.0), (1, 0.0), (2, 3.0), (3, 3.5)]


def test_ranges(spark, rows):
    log = spark.range(10).selectExpr("'t' AS topic", "0 AS partition", "id AS offset")
    read = lambda a, b: L.read_ranges(log, spark.createDataFrame(
        [("t", 0, a, b)], "topic string, partition int, `from` bigint, until bigint"))
    assert rows(read(3, 3), "offset") == []
    # Offsets of a range follow each other without a hole.
    got = [r[0] for r in rows(read(2, 6), "offset")]
    assert got == list(range(2, 6))
    with pytest.raises(Exception, match="bad range"):
        read(5, 2).collect()


def test_seek_and_lookup_by_time(spark, rows):
    log = spark.range(100).selectExpr("'t' AS topic", "0 AS partition", "id AS offset", "timestamp_millis(id * 10) AS timestamp")
    at = spark.createDataFrame([("t", 0, 90)], "topic string, partition int, offset bigint")
    sought = rows(records.from_position(log, at), "offset")
    assert len(sought) == 10 and sought[0] == (90,) and sought[-1] == (99,)
    targets = spark.createDataFrame([("t", 0, t) for t in (-5, 0, 455, 460, 991)] + [("t", 3, 0)],
                                    "topic string, partition int, target_ms bigint")
    found = rows(joins.first_at_or_after(log, targets, 64), "partition", "target_ms", "offset")
    assert found == [(0, -5, 0), (0, 0, 0), (0, 455, 46), (0, 460, 46), (0, 991, None), (3, 0, None)]
    # Times out of order: the smallest offset counts, not the nearest time.
    mixed = spark.createDataFrame([("t", 0, 0, 900), ("t", 0, 1, 100)], "topic string, partition int, offset bigint, m bigint"
                                  ).withColumn("timestamp", F.timestamp_millis("m"))
    one = spark.createDataFrame([("t", 0, 50)], "topic string, partition int, target_ms bigint")
    assert rows(joins.first_at_or_after(mixed, one, 64), "offset", "time_ms") == [(0, 900)]


def test_take_by_partition_and_until_count(spark, rows):
    log = spark.createDataFrame([("t", p, o) for p, n in ((0, 2), (1, 0), (2, 5)) for o in range(n)],
                                "topic string, partition int, offset bigint")
    ranges = spark.createDataFrame([("t", 0, 0, 2), ("t", 1, 0, 0), ("t", 2, 0, 5)],
                                   "topic string, partition int, `from` bigint, until bigint")
    assert rows(limits.take_by_partition(log, ranges, 4), "partition", "offset") == [(0, 0), (0, 1), (2, 0), (2, 1)]
    assert limits.take_by_partition(log, ranges, 0).isEmpty()
    assert limits.until_count(spark.range(500), F.expr("id div 50"), 120).count() == 150


def test_rate_plan(spark, rows):
    held = spark.createDataFrame([("t", 0, 0), ("t", 1, 0)], "topic string, partition int, offset bigint")
    latest = spark.createDataFrame([("t", 0, 100), ("t", 1, 300)], "topic string, partition int, end bigint")
    plan = lambda **k: rows(positions.rate_plan(held, latest, 2000, **k), "partition", "until")
    assert plan(rate=40, max_rate=25) == [(0, 20), (1, 50)]
    assert plan(max_rate=25) == [(0, 50), (1, 50)]
    assert plan() == [(0, 100), (1, 300)]
    done = spark.createDataFrame([("t", 0, 100), ("t", 1, 300)], "topic string, partition int, offset bigint")
    assert rows(positions.rate_plan(done, latest, 2000, rate=40), "partition", "until") == [(0, 100), (1, 300)]


def test_offset_store(spark, rows):
    held = spark.createDataFrame([("t", 0, 5), ("t", 2, 7)], "topic string, partition int, offset bigint")
    saved = positions.save_offsets(held)
    assert saved.first()["value"] == '{"offset":"{\\"0\\":5,\\"2\\":7}","version":"1"}'
    assert rows(positions.load_offsets(saved, 5), "partition", "offset") == [(0, 5), (2, 7), (3, 0), (4, 0)]
    with pytest.raises(Exception, match="empty"):
        positions.load_offsets(spark.createDataFrame([("t", '{"offset":"{}","version":"1"}')], "topic string, value string"), 2).collect()


def test_positions(spark, rows):
    ranges = spark.createDataFrame([("t", 0, 0, u) for u in (10, 30, 20)], "topic string, partition int, `from` bigint, until bigint")
    assert rows(positions.merge_commits(ranges), "offset") == [(30,)]
    bounds = spark.createDataFrame([("t", 0, 0, 9)], "topic string, partition int, begin bigint, end bigint")
    past = spark.createDataFrame([("t", 0, 12)], "topic string, partition int, offset bigint")
    with pytest.raises(Exception, match="no valid position"):
        positions.reset_positions(bounds, past, "none").collect()
    assert rows(positions.replay_when_past(ranges.where("until = 30"), bounds, 20, 4), "offset") == [(4,)]


def test_read_committed(spark, rows):
    data = [(0, 1, True, None), (1, 2, True, None), (2, 1, True, "ABORT"), (3, 2, True, "COMMIT"), (4, 1, True, None),
            (5, 1, True, "COMMIT"), (6, None, False, None), (7, 3, True, None)]
    log = spark.createDataFrame([("t", 0, *d) for d in data], "topic string, partition int, offset bigint, producer_id bigint, "
                                                             "is_transactional boolean, control string")
    for size in (1, 2, 1000):
        assert rows(positions.read_committed(log, size), "offset") == [(1,), (4,), (6,)]


def test_commit_groups(spark, rows):
    log = spark.range(470).selectExpr("'t' AS topic", "0 AS partition", "id AS offset")
    assert rows(positions.commit_groups(log, 50, 200), "rows", "committed") == [(200, True), (200, True), (70, False)]


@pytest.mark.parametrize("hub_edges", [1, 2, 1_000_000])
def test_pagerank(spark, hub_edges):
    edges = spark.createDataFrame([("1", "2"), ("1", "3"), ("1", "4"), ("2", "1"), ("3", "1"), ("4", "1"), ("4", "1")],
                                  "src string, dst string")
    got = {r["node"]: r["rank"] for r in graph.pagerank(edges, 10, 4, hub_edges).collect()}
    assert got == pytest.approx({"1": 1.7380073041193354, "2": 0.7539975652935547, "3": 0.7539975652935547,
                                 "4": 0.7539975652935547}, abs=1e-12)


def test_repeated_pairs_go_before_they_become_edges(spark, tmp_path):
    pairs = [(1, 1), (1, 1), (1, 2), (2, 1), (1, 1), (2, 1)]
    spark.createDataFrame(pairs, "l_partkey long, l_suppkey long").repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    edges = views.edges(spark, str(tmp_path), repeats=False)
    assert edges.count() == edges.distinct().count() == 6 and views.edges(spark, str(tmp_path)).count() == 12
    ranks = [{r["node"]: r["rank"] for r in df.collect()} for df in (
        graph.pagerank(edges, 2, repeats=False), graph.pagerank(views.edges(spark, str(tmp_path)), 2))]
    assert ranks[0] == pytest.approx(ranks[1], abs=1e-12) and set(ranks[0]) == {"p1", "p2", "s1", "s2"}


def test_key_partition(spark):
    keys = {"21": -973932308, "foobar": -790332482, "key1": 28543940, "asset01": 1085090301, "myAsset": 833033824,
            "": 275646681, "a-little-bit-long-string": -985981536}
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r["k"]: r["h"] for r in df.select("k", partitioner.murmur2(F.encode("k", "UTF-8")).alias("h")).collect()}
    assert got == keys
    first = df.limit(6).select(partitioner.key_partition(F.encode("k", "UTF-8"), 4)).collect()
    assert [r[0] for r in first] == [0, 2, 0, 1, 0, 1]


def test_decode_binary(spark):
    decode = lambda raw, kind: spark.createDataFrame([(bytearray(raw),)], "b binary").select(
        binary.decode_binary(F.col("b"), kind)).first()[0]
    assert decode(bytes.fromhex("FFFFFFFE"), "int") == -2 and decode(bytes.fromhex("00000102"), "int") == 258
    with pytest.raises(Exception, match="needs 4 bytes"):
        decode(b"123", "int")
    for number in (0.0, -1.5, 1e308, 5e-324, 2.2250738585072014e-308, math.pi, math.inf, -math.inf):
        assert decode(struct.pack(">d", number), "double") == number
    for number in (0.1, -3.5, 1e-45, 3.4028235e38, math.inf):
        want = struct.unpack(">f", struct.pack(">f", number))[0]
        assert decode(struct.pack(">f", number), "float") == want
    assert math.isnan(decode(struct.pack(">d", math.nan), "double"))
    assert decode(struct.pack(">q", -2 ** 63), "long") == -2 ** 63 and decode(struct.pack(">h", -2), "short") == -2
    assert spark.sql("SELECT cast(NULL AS binary) AS b").select(binary.decode_binary(F.col("b"), "int")).first()[0] is None


@pytest.mark.parametrize("kind,pattern,values", [
    ("short", ">h", [-2, 7]), ("int", ">i", [-2, 258]), ("long", ">q", [-9, 2 ** 62]), ("float", ">f", [1.5, -0.25]),
    ("double", ">d", [math.pi, -1e300])])
def test_encode_binary(spark, kind, pattern, values):
    spark_type = {"short": "smallint", "long": "bigint"}.get(kind, kind)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], f"v {spark_type}")
    got = [None if r[0] is None else bytes(r[0]) for r in df.select(binary.encode_binary(F.col("v"), kind)).collect()]
    assert got == [struct.pack(pattern, v) for v in values] + [None]


def test_md5_and_typed_fields(spark, rows):
    one = spark.createDataFrame([(1, '{"a":[1.5,{"b":null}],"c":"x"}'), (2, "7"), (3, "{bad")], "id int, t string")
    assert one.select(scalar.md5_hex(F.lit("a"))).first()[0] == "0cc175b9c0f1b6a831c399e269772661"
    assert rows(typed.typed_fields(one, ["id"], "t")) == [
        (1, "", "MAP", None), (1, "/a", "LIST", None), (1, "/a[0]", "DECIMAL", "1.5"), (1, "/a[1]", "MAP", None),
        (1, "/a[1]/b", "STRING", None), (1, "/c", "STRING", "x"), (2, "", "LONG", "7")]


def _by_level(df, keys, payload):
    """Typed fields level by level, from Spark's own view of the JSON."""
    level = df.select(*keys, F.lit("").alias("path"), F.try_parse_json(payload).alias("node")).where("node is not null")
    out = set()
    while not level.isEmpty():
        level = level.withColumn("type", typed.field_type(F.col("node")))
        leaf = F.when(~F.col("type").isin("MAP", "LIST"), F.try_variant_get("node", "$", "string")).alias("value")
        out |= {tuple(r) for r in level.select(*keys, "path", "type", leaf).collect()}
        inner = level.where(F.col("type").isin("MAP", "LIST"))
        children = df.sparkSession.tvf.variant_explode(F.col("node").outer())
        step = F.when(F.col("type") == "MAP", F.concat("path", F.lit("/"), "key")).otherwise(
            F.concat("path", F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        level = inner.lateralJoin(children).select(*keys, step.alias("path"), F.col("value").alias("node"))
    return out


def test_typed_fields_of_odd_texts(spark):
    """Numbers of all lengths and notations, escapes, empty containers, depth, and texts that are no JSON."""
    texts = ["1", "-0", "-0.0", "1.50", "100.00", "1e2", "1E-7", "12345678.25", "0.0001", "1e400", "9223372036854775807",
             "9223372036854775808", "1" * 38, "1" * 39, "0." + "1" * 38, "1." + "2" * 40, "123456789.123e-5", "true", "null", '"x"', '""',
             "[]", "{}", '{"":{"":[]}}', '{"a":[1,[2,[3.0,{"b":"c/[0]"}]],"\\u00e9\\n\\ud83d\\ude00"]}', ' [1, 2 ] ', "nope", "", "[1,",
             '{"a":1,"a":2}', "NaN", "01", "[1] ", '{"d":"2024-01-01"}', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = [tuple(r) for r in typed.typed_fields(df, ["id"], "t").collect()]
    assert len(got) == len(set(got)) and set(got) == _by_level(df, ["id"], "t") and len({r[0] for r in got}) > 25
    deep = spark.createDataFrame([(1, "[" * 300 + "7" + "]" * 300)], "id int, t string")
    fields = typed.typed_fields(deep, ["id"], "t").collect()
    assert len(fields) == 301 and max(fields, key=lambda r: len(r["path"]))["value"] == "7"


def test_table_function_gets_each_key_in_order(spark):
    import pyarrow as pa

    class Running:
        def __init__(self):
            self.total, self.key = 0, None

        def eval(self, batch):
            keys, values = batch.column("k").to_pylist(), batch.column("v").to_pylist()
            sums = []
            for v in values:
                self.total += v
                sums.append(self.total)
            yield pa.table({"k": pa.array(keys, pa.int64()), "v": pa.array(values, pa.int64()), "sum": pa.array(sums, pa.int64())})

    df = spark.range(300).selectExpr("id % 7 AS k", "300 - id AS v")
    got = transforms.table_function(df, Running, "k bigint, v bigint, sum bigint", ["k"], ["v"])
    want = df.selectExpr("k", "v", "sum(v) OVER (PARTITION BY k ORDER BY v) AS sum")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_draws_agree_with_program(spark):
    got = [r[0] for r in spark.range(50).select(draw(F.col("id"), 9, 26)).collect()]
    assert got == [draw_int(i, 9, 26) for i in range(50)] and len(set(got)) > 15


def test_generated_rows(spark):
    lines = [r[0].split(" ") for r in spark.range(500).select(generate.word_line(F.col("id"), 1)).collect()]
    assert {len(line) for line in lines} <= set(range(2, 10)) and {w for line in lines for w in line} == set(generate.WORDS)
    payload = spark.range(2).select(generate.fixed_payload(100)).collect()
    assert len(payload[0][0]) == 100 and payload[0] == payload[1] and payload[0][0].isalpha() and payload[0][0].isupper()
    record = generate.fixed_rate(spark.sql("SELECT 6000L AS s"), "s", 2, "record").collect()
    assert [r["key"] for r in record] == ["0", "1"] and '"attr":{"calQuality":0,"id":1}' in record[0]["value"]


def test_text_sources(spark, rows, tmp_path):
    df = spark.createDataFrame([("a",), ("b",)], "value string")
    files.write_text(df, f"{tmp_path}/t")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_text(df, f"{tmp_path}/t")
    assert files.text_lines(spark, f"{tmp_path}/t", 5).rdd.getNumPartitions() >= 5
    (tmp_path / "p").write_text("x;y z;w")
    assert rows(files.text_delimited(spark, f"{tmp_path}/p", ";")) == [("w",), ("x",), ("y z",)]
    (tmp_path / "e").write_text("")
    with pytest.raises(ValueError, match="no payload"):
        files.text_delimited(spark, f"{tmp_path}/e")
    assert files.inline_rows(spark, [], "a int, b string").columns == ["a", "b"]


def test_placement(spark):
    many = spark.range(0, 80, 1, 8)
    sizes = {p: transforms.repartition_to(many, p).rdd.getNumPartitions() for p in (4, 8, 12, -1)}
    assert sizes == {4: 4, 8: 8, 12: 12, -1: 8}
    for level in transforms.LEVELS:
        with transforms.kept(many.selectExpr("id * 2 AS x"), level) as held:
            assert held.is_cached and held.count() == 80
        assert not held.is_cached


def test_map_partitions_sees_its_index(spark):
    def first_index(batches):
        for pdf in batches:
            yield pdf[["id", "partition_index"]]

    out = transforms.map_partitions(spark.range(0, 8, 1, 4), first_index, "id bigint, partition_index int", True)
    assert {(r["id"] // 2, r["partition_index"]) for r in out.collect()} == {(i, i) for i in range(4)}


def test_sampled_rate_padding(spark):
    stats = spark.createDataFrame([("s", 100.0, 90_000)], "series string, sum double, oldest_ms bigint")
    assert monitor.sampled_rate(stats, 100_000).first()["rate"] == 2.5
    assert monitor.sampled_rate(stats, 100_000, simple=True).first()["rate"] == pytest.approx(100 / 30)


def test_log_options():
    options = L.kafka_options("h:1", topics=["a", "b"], starting={"a": {0: 5}}, max_offsets_per_trigger=7, headers=True)
    assert options == {"kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": '{"a": {"0": 5}}',
                       "maxOffsetsPerTrigger": "7", "includeHeaders": "true"}
    with pytest.raises(ValueError):
        L.kafka_options("h:1", topics=["a"], pattern="b")


def test_session_zone_is_pinned(spark):
    from tidemark.session import use_utc

    for zone in ("Europe/Paris", None):
        spark.conf.set("spark.sql.session.timeZone", zone) if zone else spark.conf.unset("spark.sql.session.timeZone")
        use_utc(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_shared_folder_comes_from_the_session(spark):
    from tidemark.session import scratch_path, shared_dir

    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == base and scratch_path(spark, "x").startswith(f"{base}/tidemark/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
