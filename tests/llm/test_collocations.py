"""Phrase mining against a plain count of everything, and its edge rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import collocations
from tidemark.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least, top=2000, longest=5):
    freq, words = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    freq[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, f in freq.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        rows = []
        for p, a in often.items():
            if inside[p] < a:
                score, k = min((1000 * a * words[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], words[lang], -x[0]) for i, x in enumerate(sorted(rows)[:top])]
    return sorted(out)


def mined(docs, **how):
    return sorted(tuple(r) for r in collocations.collocations(docs, **how).collect())


@pytest.mark.parametrize("least,top", [(3, 2000), (20, 7)])
def test_equals_plain_count(spark, least, top):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    want = plain(rows, least, top)
    assert want and mined(docs, least=least, top=top) == want


def test_hot_prefixes_small_bitmaps_and_steps(spark, monkeypatch):
    """Prefixes in parts, bits set by several phrases and merges in many steps change nothing."""
    monkeypatch.setattr(collocations, "SHARES", 1 << 16)
    monkeypatch.setattr(collocations, "BITS", 1 << 8)
    monkeypatch.setattr(collocations, "STEP", 50)
    monkeypatch.setattr(collocations, "HASH_STEP", 40)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 200)
    monkeypatch.setattr(collocations, "SALTS", 3)
    rows = [(f"a b {x} a b c{x % 3} a a a", "en") for x in range(60)] * 3 + [("a b", "de")] * 9
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    want = plain(rows, 3)
    assert any(r[0] == "de" for r in want) and mined(docs, least=3) == want


def test_edges(spark):
    """Null, empty and very long texts, null languages, repeated rows, ties and clashing columns."""
    rows = [(None, "en", 1), ("", None, 1), ("x Y x y. x y", None, 1), ("x y\tx  y", "und", 2), ("p q", "en", 3),
            ("p q", "en", 3), ("q r;q r", "en", 3), ("é É é É", "fr", 1), ("b c " * 200_000, "big", 1), ("...", "de", 1)]
    docs = spark.createDataFrame(rows, "text string, lang string, n long").withColumnsRenamed({"n": "prefix"})
    for least in (1, 2):
        assert mined(docs, least=least) == plain([r[:2] for r in rows], least)


def test_empty_tables(spark):
    assert mined(spark.createDataFrame([], "doc_id long, text string, lang string")) == []
    assert mined(spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string"), least=1) == []


def test_hash_does_not_depend_on_the_block():
    import pyarrow as pa

    from tidemark.llm.wordblocks import byte_set, word_block, word_hashes

    words = ["a", "bb", "é", "x" * 1000, ""]
    together = word_hashes(pa.array(words))
    assert [int(word_hashes(pa.array([w]))[0]) for w in words] == together.tolist()
    assert len(np.unique(together)) == len(words)
    cut = word_block(pa.array(["A b\tc", None, "", "b"]), byte_set(" \t"))
    assert cut.words.take(pa.array(cut.codes)).to_pylist() == ["a", "b", "c", "b"] and cut.text.tolist() == [0, 0, 0, 3]
