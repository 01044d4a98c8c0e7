"""Document likelihoods against plain sums over all segmentations, and their edge rows."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lattice
from tidemark.llm.common import table
from tidemark.llm.queries import tokenizer_file
from tidemark.llm.wordblocks import _LOWER

SF_DIR = "/root/testdata/sf0.001"
VOCABULARY = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return lattice.read_pieces(VOCABULARY)


def plain_table():
    """Pieces and their places in the weights, read from the file a second way."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    kept = [i for i in range(3, model.get_piece_size()) if model.is_byte(i) or not (
        "▁" in model.id_to_piece(i)[1:] or re.search("[A-Z]", model.id_to_piece(i)))]
    names = {("byte", int(model.id_to_piece(i)[3:5], 16)) if model.is_byte(i) else model.id_to_piece(i): k
             for k, i in enumerate(kept)}
    return names


def plain_sum(word, names, weight, counts=None):
    """Sum over all segmentations, and with ``counts`` each piece's expected uses, by recursion over places."""
    marked = "▁" + word.replace("▁", "\ue000")  # a mark of the word's own is no mark
    n = len(marked)

    def arcs(i):
        out = [(i + k, (names[marked[i:i + k]],)) for k in range(1, n - i + 1) if marked[i:i + k] in names]
        if i and marked[i] not in names:
            char = "▁" if marked[i] == "\ue000" else marked[i]
            out.append((i + 1, tuple(names["byte", b] for b in char.encode())))
        return out

    ahead = [0.0] * n + [1.0]
    for i in range(n - 1, -1, -1):
        ahead[i] = sum(math.exp(sum(weight[p] for p in used)) * ahead[j] for j, used in arcs(i))
    if counts is not None:
        reach = [1.0] + [0.0] * n
        for i in range(n):
            for j, used in arcs(i):
                share = reach[i] * math.exp(sum(weight[p] for p in used))
                reach[j] += share
                for p in used:
                    counts[p] += share * ahead[j] / ahead[0]
    return ahead[0]


WORDS = ["the", "tionation", "x", "été", "日本", "☃snow", "a▁b", "zz1,2", "", "the"]


def test_forward_and_expected_counts(pieces):
    names = plain_table()
    assert len(names) == len(pieces.weight) and math.isclose(np.exp(pieces.weight).sum(), 1)
    held = lattice.Lattices(WORDS, pieces)
    counts = Counter()
    want = [math.log(plain_sum(w, names, pieces.weight, counts)) for w in WORDS]
    assert np.allclose(held.marginal(pieces.weight), want, rtol=1e-10)
    used = held.expected(pieces.weight)
    assert np.allclose([used[p] for p in counts], list(counts.values())) and math.isclose(used.sum(), sum(counts.values()))


def plain_scores(rows, passes):
    """doc -> n_tokens, n_known, N, base, score, straight from the formulas; rows: id, text, lang, train."""
    names, start = plain_table(), np.exp(lattice.read_pieces(VOCABULARY).weight)
    lower = {i: chr(c) for i, c in enumerate(_LOWER.tolist()) if i < 128}
    tokens = [re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate(lower)) for _, t, _, _ in rows]
    by_lang, ends = defaultdict(Counter), Counter()
    for (_, _, lang, train), words in zip(rows, tokens, strict=True):
        if train:
            by_lang[lang or "und"].update(words)
            ends[lang or "und"] += 1
    langs = sorted(k for k, c in by_lang.items() if c)
    every = sum(by_lang.values(), Counter())
    weights = {lang: np.log(start) for lang in langs}
    together = np.log(start)
    for _ in range(passes if langs else 0):
        sums = {}
        for lang in langs:
            sums[lang] = Counter()
            for w in by_lang[lang]:
                plain_sum(w, names, weights[lang], sums[lang])
        def fitted(counts):
            total = lattice.PRIOR_COUNTS * start
            for p, v in counts.items():
                total[p] += v
            return np.log(total / total.sum())
        weights = {lang: fitted(c) for lang, c in sums.items()}
        together = fitted(sum(sums.values(), Counter()))

    def mass(counter):
        n, once, twice = sum(counter.values()), sum(v == 1 for v in counter.values()), sum(v == 2 for v in counter.values())
        d = min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.5
        return (lambda c: max(c - d, 0) / n if n else 0.0), d * len(counter) / n if n else 1.0

    known_all, new_all = mass(every)
    n_all, e = sum(every.values()) + sum(ends.values()), sum(ends.values())
    kinds, stop = len(every) + (e > 0), (e + 1) / (n_all + 2)
    share = np.array([ends[lang] for lang in langs] + [1])
    share = share / share.sum()
    out = []
    for (doc, _, _, _), words in zip(rows, tokens, strict=True):
        base = sum(math.log10((every[w] + 1) / (n_all + kinds + 1)) for w in words) + math.log10((e + 1) / (n_all + kinds + 1))
        anyone = {w: known_all(every[w]) + new_all * plain_sum(w, names, together) for w in set(words)}
        ways = []
        for lang in langs:
            known, new = mass(by_lang[lang])
            p = {w: known(by_lang[lang][w]) + new * (lattice.OTHER * anyone[w] + (1 - lattice.OTHER) * plain_sum(
                w, names, together if every[w] else weights[lang])) for w in set(words)}
            ways.append(sum(math.log10(p[w]) for w in words))
        ways = np.array([*ways, sum(math.log10(anyone[w]) for w in words)]) + np.log10(share)
        score = ways.max() + math.log10((10 ** (ways - ways.max())).sum()) + len(words) * math.log10(1 - stop) + math.log10(stop)
        out.append((doc, len(words) + 1, sum(every[w] > 0 for w in words) + (e > 0), n_all, base, score))
    return out


def compare(got, want):
    order = lambda r: (str(r[0]), r[1], round(r[4], 6))
    got, want = sorted((tuple(r) for r in got), key=order), sorted(want, key=order)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=2e-6, abs=1e-9), (a, b)


COLUMNS = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def test_scores_of_a_table(spark, monkeypatch):
    """Several blocks, lists and lattices at a time."""
    monkeypatch.setattr(lattice, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(lattice, "LIST_WORDS", 20)
    monkeypatch.setattr(lattice, "LATTICE_CHARS", 300)
    docs = table(spark, SF_DIR, "documents").where("length(text) < 1500").limit(60)
    rows = [(r.doc_id, r.text, r.lang, r.doc_id % 3 != 1) for r in docs.collect()]
    got = lattice.score_texts(docs.repartition(3), VOCABULARY, F.col("doc_id") % 3 != 1, passes=2)
    compare(got.select(*COLUMNS).collect(), plain_scores(rows, 2))


EDGES = [(1, None, "en", True), (2, "", None, True), (None, "The cat sat", "en", True), (4, "the\tcat\n日本 ☃", "en", False),
         (4, "the\tcat\n日本 ☃", "en", False), (5, "le chat", "fr", True), (6, " \x0b ", "zz", True), (7, "Le CHAT inconnu", None, False)]


def test_edges(spark):
    """Null and empty texts, null ids and languages, repeated rows, a language without words, clashing columns."""
    docs = spark.createDataFrame([(*r, 0) for r in EDGES], "doc_id long, text string, lang string, t boolean, block int")
    compare(lattice.score_texts(docs, VOCABULARY, F.col("t")).select(*COLUMNS).collect(), plain_scores(EDGES, lattice.PASSES))
    # Nothing to learn from: the file's own weights.
    none = [(*r[:3], False) for r in EDGES]
    compare(lattice.score_texts(docs, VOCABULARY, F.lit(False)).select(*COLUMNS).collect(), plain_scores(none, 0))
    assert lattice.score_documents(docs.limit(0), VOCABULARY).collect() == []


def test_very_long_texts(spark):
    docs = spark.createDataFrame([(1, "word " * 300_000, "en"), (2, "qx" * 20_000, "en"), (3, "Word", "en")],
                                 "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in lattice.score_texts(docs, VOCABULARY, F.col("doc_id") != 2).collect()}
    assert got[1].n_tokens == 300_001 and got[1].n_known == 300_001 and got[2].n_known == 1
    assert all(math.isfinite(r.score) and r.score < 0 for r in got.values()) and got[2].score < -10_000


def test_held_out_texts_of_known_words(spark):
    """Where words are known, the model is better than the base, and it learns from the training rows only."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    rows = lattice.score_documents(docs, VOCABULARY).where("held_out").collect()
    most = [r for r in rows if r.n_known >= 0.9 * r.n_tokens]
    assert len(most) > 30 and sum(r.score for r in most) > sum(r.base_score for r in most)
