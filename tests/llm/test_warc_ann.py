"""Archives and neighbour search against plain versions, and their edge rows."""

import base64
import hashlib
import struct

import numpy as np
import pytest

from tidemark.llm import ann, queries, warc
from tidemark.llm.common import table
from tidemark.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows):
    largest = {}
    for page, text in rows:
        if page is not None:
            largest[text or ""] = max(largest.get(text or "", page), page)
    out = []
    for page, text in rows:
        head = largest.get(text or "")
        revisit = head is not None and page != head
        out.append((page, len((text or "").encode()), sha(text), "revisit" if revisit else "response", head if revisit else None))
    return sorted(out, key=str)


def test_warc_query(spark):
    pages = [tuple(r) for r in table(spark, SF_DIR, "pages").select("page_id", "html").collect()]
    got = [tuple(r) for r in queries.QUERIES["op9_warc_archives"](spark, SF_DIR).collect()]
    assert sorted(got, key=str) == expected(pages)


def test_warc_edges_and_whole_payloads(spark):
    rows = [(1, "u", "same"), (5, "u\r\nX: y", "same"), (5, "u", "same"), (None, None, "same"), (None, None, "alone"), (7, "u", None),
            (8, "u", ""), (9, "ü x", "<p>🙂</p>\r\n\r\nWARC/1.1\r\n" + "y" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS sha", "2 AS head")
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages, path, archive_bytes=100_000)
    got = warc.read_archives(spark, path).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == \
        expected([(a, c) for a, _, c in rows])
    assert {bytes(r.payload) for r in got if r.record_type == "response"} == {(c or "").encode() for _, _, c in rows}
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages.where("false"), path)
    assert warc.read_archives(spark, path).count() == 0


def test_rows_that_repeat_spread_over_archives(spark):
    pages = spark.createDataFrame([(1, "u", "x" * 1000)] * 200, "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages, path, archive_bytes=20_000)
    files = spark.read.format("binaryFile").load(path).select("content").collect()
    counts = [sum(1 for _ in warc.read_archive(bytes(f.content))) for f in files]
    assert sum(counts) == 200 and max(counts) <= 60


def test_archives_are_plain_zstandard_with_a_leading_dictionary(spark):
    import glob

    import zstandard

    path = scratch_path(spark, "warc-test")
    warc.write_archives(table(spark, SF_DIR, "pages"), path)
    for file in glob.glob(path.removeprefix("file:") + "/part-*"):
        data = open(file, "rb").read()
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICTIONARY_MAGIC
        known = zstandard.ZstdCompressionDict(data[8:8 + size]) if size else None
        reader = zstandard.ZstdDecompressor(dict_data=known).stream_reader(data[8 + size:], read_across_frames=True)
        records = list(warc.read_archive(data))
        assert reader.read() == b"".join(records) and records


@pytest.mark.parametrize("spoil", [
    lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"), lambda r: r.replace(b"WARC-Date", b"X-Date"), lambda r: r[:-1],
    lambda r: r.replace(b"payload", b"pAyload"), lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: other")])
def test_spoilt_records_are_refused(spoil):
    record = warc.make_record(3, "u", b"payload", None, False)
    assert warc.parse_record(record)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(spoil(record))


def brute_force(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for q in sorted({i for i in ids if i % 20 == 0}):
        score = (x * x[ids == q][0]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), score[j]) for j in order]
    return out


def test_search_finds_what_brute_force_finds(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_DIR, "embeddings").select("vec_id", "embedding").collect()]
    want = brute_force(rows, 20)
    got = {}
    for r in queries.QUERIES["op10_one_bit_search"](spark, SF_DIR).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want)
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert found >= 0.95 * sum(map(len, want.values()))
    scores = {(q, i): s for q, x in want.items() for i, s in x}
    assert all(scores[q, i] == pytest.approx(s, abs=1e-12) for q, x in got.items() for i, s in x if (q, i) in scores)


def test_codes_are_selective(spark):
    """The bounds leave most vectors out, and hold nearly always."""
    draw = np.random.default_rng(1)
    x = draw.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn = ann.rotation(64)
    turned = x @ turn.T
    fit = np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[0])
    low, high = ann.bounds(np.packbits(turned > 0, axis=1), np.ones(len(x)), fit, x[:50], turn)
    exact = x[:50] @ x.T
    np.fill_diagonal(exact[:, :50], 0)
    inside = (exact >= low - 1e-6) & (exact <= high + 1e-6)
    assert inside.mean() > 0.98
    kth = np.sort(exact, axis=1)[:, -20]
    assert (high >= kth[:, None]).mean() < 0.2


def test_search_in_double_precision_and_every_dimension(spark):
    tiny = 1e-60
    rows = [(0, [0.1, 0.2]), (1, [0.1000000000001, 0.2]), (2, [tiny, tiny]), (3, [1.0, 2.0, 3.0]), (20, [1.0, 0.0, 0.0]),
            (40, [tiny, 0.0]), (5, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in ann.nearest(df, "vec_id % 20 = 0", k=2).collect()}
    assert got == {(0, 1): (1, 0.1 * 0.1000000000001 + 0.2 * 0.2), (0, 2): (2, 0.1 * tiny + 0.2 * tiny), (20, 1): (3, 1.0),
                   (40, 1): (1, 0.1000000000001 * tiny), (40, 2): (0, 0.1 * tiny)}
    assert ann.nearest(df.where("false"), "vec_id % 20 = 0").count() == 0


def test_search_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [1.0]), (20, [0.0, -1.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS norm", "'x' AS vector")
    index, dimension = ann.build_index(df)
    out = ann.search(index, dimension, index.where("vec_id % 20 = 0").select("vec_id", "vector"), k=3)
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(0, 1, 2, 2.0), (0, 2, 1, 1.0), (0, 3, 1, 1.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 1, 0.0)]
    index, dimension = ann.build_index(df.where("false"))
    assert ann.search(index, dimension, index.select("vec_id", "vector")).count() == 0
