"""Language and token files against plain versions, and their edge rows."""

import random
import zlib

import numpy as np
import pytest

from tidemark.llm import language, queries, tokens
from tidemark.llm.common import table
from tidemark.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"


def plain_parse(text, sample):
    """Phrases of a greedy parse by substring search."""
    n, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in sample:
            end += 1
        at = max(at + 1, end - 1)
        n += 1
    return n


def test_automaton_parses_like_substring_search():
    random.seed(5)
    samples = {k: "".join(random.choice(a) for _ in range(400)) for k, a in (("x", "abc"), ("y", "bcd "))}
    parser = language.CrossParser(samples)
    texts = ["".join(random.choice("abcd") for _ in range(n)) for n in (1, 5, 60, 300)]
    codes = np.array([ord(c) for t in texts for c in t], np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = parser.entropies(codes, starts)
    for i, text in enumerate(texts):
        for j, name in enumerate(parser.languages):
            known = "".join(c if c.isalpha() else " " for c in samples[name])
            known = "".join(c for k, c in enumerate(known) if c != " " or k == 0 or known[k - 1] != " ")
            want = plain_parse(text, known) * np.log2(len(known)) / len(text)
            assert got[i, j] == pytest.approx(want)


def test_long_text_is_cut_into_lanes_for_all_languages_alike(spark):
    long = "the cat and the dog " * 2000
    docs = spark.createDataFrame([(1, long)], "doc_id long, text string")
    row = language.predict(docs, {"en": "the cat and the dog sat " * 20, "zz": "qvx wkj zpt " * 30}).first()
    assert row.lang_pred == "en" and row.score > 0.9


def test_language_edges(spark):
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "12 !? 3"), (None, "hello there"), (4, "hello there"), (4, "hello there")],
        "doc_id long, text string").selectExpr("*", "'x' AS lang_pred", "1D AS score")
    rows = language.predict(docs, {"en": "hello there general " * 10, "de": "guten tag zusammen " * 10}).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in rows) == [
        (0, "en"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en")]
    assert {r.lang_pred for r in language.predict(docs, {}).collect()} == {"und"}
    empty = docs.where("false").selectExpr("doc_id", "text", "'en' AS lang")
    assert language.identify(empty).count() == 0


def test_language_learns_only_from_its_share_and_predicts_held_out(spark):
    rows = queries.QUERIES["op1_cross_parsing"](spark, SF_DIR)
    truth = table(spark, SF_DIR, "documents").select("doc_id", "lang")
    both = rows.join(truth, "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in both)
    assert sum(r.lang == r.lang_pred for r in both) >= 0.95 * len(both)


@pytest.fixture(scope="module")
def encoder():
    with open(queries.tokenizer_file(), encoding="utf-8") as f:
        return tokens.PieceEncoder(f.read())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_file())


def test_pieces_give_the_library_ids(encoder, library):
    random.seed(3)
    abc = [*"ab Z9 _-.\n\t'!  ", "é", "ß", "漢", "٣", "½", "Ⅷ", " ", " ", "🙂", "́", "'s", "<|endoftext|>",
           "\x1c", "\0", "ſ", "\r\n", " a", " 1", " _", "x" * 70]
    for _ in range(60):
        texts = ["".join(random.choice(abc) for _ in range(random.randint(0, 40))) for _ in range(15)]
        ids, counts = encoder.encode(texts)
        want = [library.encode(x, add_special_tokens=False).ids for x in texts]
        assert ids.tolist() == [i for w in want for i in w]
        assert counts.tolist() == [len(w) for w in want]


def test_names_of_added_tokens_are_cut_as_the_library_does(encoder, library):
    texts = ["one <|endoftext|> two", "", "plain", "<|endoftext|>", "x<|endoftext|><|endoftext|> y " * 50, "<|endoftext", "end"]
    ids, counts = encoder.encode(texts)
    want = [library.encode(x, add_special_tokens=False).ids for x in texts]
    assert library.token_to_id("<|endoftext|>") in want[0]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]


def digest_rows(library, docs):
    start, out = 0, []
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_query_round_trip(spark, library):
    docs = sorted(tuple(r) for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect())
    got = queries.QUERIES["op3_token_files"](spark, SF_DIR).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == digest_rows(library, docs)


def test_token_file_edges(spark, library):
    rows = [(3, "b b"), (None, "no id"), (1, None), (2, ""), (3, "b b"), (9, "z " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS part", "2 AS n_tokens")
    for dictionary in (True, False):
        path = scratch_path(spark, "token-test")
        tokens.write_tokens(docs, path, queries.tokenizer_file(), partitions=3, dictionary=dictionary)
        want = digest_rows(library, [(None, "no id"), (1, None), (2, ""), (3, "b b"), (3, "b b"), (9, "z " * 50_000)])
        assert [tuple(r) for r in tokens.token_digests(spark, path).orderBy("start").collect()] == want
        meta = tokens.token_metadata(spark, path)
        assert [tuple(r) for r in meta.orderBy("start").collect()] == [w[:3] for w in want]
        assert "ids" not in meta._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    path = scratch_path(spark, "token-test")
    tokens.write_tokens(docs.where("false"), path, queries.tokenizer_file())
    assert tokens.token_digests(spark, path).count() == 0


def test_encodings_and_page_indexes_are_in_the_files(spark):
    import glob

    import pyarrow.parquet as pq

    docs = spark.createDataFrame([(i, "word and word " * 40) for i in range(300)], "doc_id long, text string")
    for dictionary, name in ((True, "RLE_DICTIONARY"), (False, "DELTA_BINARY_PACKED")):
        path = scratch_path(spark, "token-test")
        tokens.write_tokens(docs, path, queries.tokenizer_file(), partitions=1, page_rows=50, dictionary=dictionary)
        found = []
        for file in glob.glob(path.removeprefix("file:") + "/*.parquet"):
            group = pq.ParquetFile(file).metadata.row_group(0)
            found += [group.column(i) for i in range(group.num_columns) if group.column(i).path_in_schema.startswith("ids")]
        assert found and all(name in str(c.encodings) or (dictionary and "PLAIN_DICTIONARY" in str(c.encodings))
                             for c in found)
        assert all(c.has_offset_index and c.has_column_index for c in found)
