"""Join, decontamination, packing and the pipeline against plain versions, and edge rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import components, decontaminate, jaccard, packing, queries
from tidemark.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def shingles(text):
    words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_join(docs):
    """Links and classes by looking at all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in docs}
    by, links = defaultdict(list), defaultdict(set)
    for i, s in sets.items():
        common = Counter(j for x in s for j in by[x])
        for j, n in common.items():
            if 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                links[i].add(j)
                links[j].add(i)
        for x in s:
            by[x].append(i)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in links:
        for j in links[i]:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return {i: (find(i), len(links[i])) for i in sets}


def test_join_query_agrees_with_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, MEDIUM, "documents").collect()]
    got = {r.doc_id: (r.class_id, r.n_links) for r in queries.QUERIES["op4_chosen_path_join"](spark, MEDIUM).collect()}
    assert got == plain_join(docs)


def varied(count, changes, seed):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10 ** 6)}" for _ in range(120)]
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(changes):
            words[draw.randrange(len(words))] = f"v{draw.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


def test_large_buckets_lose_no_link(spark, monkeypatch):
    """A group above all limits goes through pivots, splits and blocks."""
    monkeypatch.setattr(jaccard, "SMALL", 8)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 16)
    texts = varied(70, 1, 1) + varied(40, 2, 2) + varied(30, 4, 3) + ["lonely words stand here all alone"]
    docs = list(enumerate(texts))
    got = {r.doc_id: (r.class_id, r.n_links)
           for r in jaccard.join_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = plain_join(docs)
    assert sum(n for _, n in got.values()) >= 0.97 * sum(n for _, n in want.values())
    assert all(got[i][1] <= want[i][1] for i in want)
    assert sum(got[i][0] == want[i][0] for i in want) >= 0.97 * len(want)


def test_runs_reach_the_target_recall():
    assert 1 - (1 - jaccard.survival(0.8, 4)) ** jaccard.RUNS >= jaccard.TARGET
    assert jaccard.survival(1.0, 6) == 1.0 and jaccard.survival(0.3, 4) < 0.05


def templates(count, pairs, seed):
    """Texts of 24 lines, each one of two known ones, so that every bucket stays large for long; the last ``pairs`` of
    them differ from the first ones in two lines."""
    draw = random.Random(seed)
    lines = [[" ".join(f"w{draw.randrange(10 ** 9)}" for _ in range(20)) for _ in range(2)] for _ in range(24)]
    picks = [[draw.randrange(2) for _ in lines] for _ in range(count)]
    for own in picks[:pairs]:
        changed = draw.sample(range(24), 2)
        picks.append([1 - p if i in changed else p for i, p in enumerate(own)])
    return [" ".join(x[p] for x, p in zip(lines, own, strict=True)) for own in picks]


def test_deep_paths_take_further_rounds(spark, monkeypatch):
    """Rounds go on, on other minhashes, until all of them together reach the target at the depth of their paths."""
    monkeypatch.setattr(jaccard, "SMALL", 4)
    monkeypatch.setattr(jaccard, "CANDIDATE", 0.6)
    split, rounds, seen = jaccard._round, [], []

    def spied(sets, turn, runs, before):
        seen.append({r.node: r.sig for r in sets.collect()})
        links, deep, depth = split(sets, turn, runs, before)
        rounds.append((runs, depth))
        return links, deep, depth

    monkeypatch.setattr(jaccard, "_round", spied)
    docs = spark.createDataFrame(list(enumerate(templates(150, 50, 5))), "doc_id long, text string")
    links = {r.doc_id: r.n_links for r in jaccard.join_documents(docs).collect()}
    assert sum(links[i] > 0 for i in range(50)) >= jaccard.TARGET * 50
    assert jaccard.missed(rounds[0][1], jaccard.RUNS) > 1 - jaccard.TARGET and len(rounds) > 1
    assert np.prod([jaccard.missed(depth, runs) for runs, depth in rounds]) <= 1 - jaccard.TARGET
    assert seen[1] and all(sig != seen[0][node] for node, sig in seen[1].items())


def test_misses_of_a_round():
    for depth, chance in ((4, 0.989), (8, 0.932), (12, 0.857)):
        assert 1 - jaccard.missed(depth, 6) == pytest.approx(chance, abs=1e-3)
    assert jaccard.missed(4, jaccard.RUNS) <= 1 - jaccard.TARGET


def test_a_partner_of_a_near_set_is_linked_to_the_pivot():
    assert jaccard.lost_at_pivot() < 1e-4


def boilerplate(count, pairs, seed):
    """Texts of which 62 % is one passage; the last ``pairs`` repeat the first ones but for their last words."""
    draw = random.Random(seed)
    passage = " ".join(f"b{i}" for i in range(124))
    own = [[f"u{draw.randrange(10 ** 9)}" for _ in range(76)] for _ in range(count)]
    own += [[*words[:-8], *(f"z{draw.randrange(10 ** 9)}" for _ in range(8))] for words in own[:pairs]]
    return [f"{passage} {' '.join(words)}" for words in own]


def test_texts_of_one_template_part(spark, monkeypatch):
    """A template gathers thousands of texts; few pairs are left to the exact check, and planted ones are found."""
    exact, compared = jaccard.exact_links, []

    def spied(gathered, wanted):
        compared.extend(r.c * (r.c - 1) // 2 for r in wanted.groupBy("root").agg(F.count(F.lit(1)).alias("c")).collect())
        return exact(gathered, wanted)

    monkeypatch.setattr(jaccard, "exact_links", spied)
    pairs, count = 200, 5800
    docs = spark.createDataFrame(list(enumerate(boilerplate(count, pairs, 9))), "doc_id long, text string").repartition(8)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join_documents(docs).where("n_links > 0").collect()}
    assert sum(compared) < 50 * 6000
    assert sum(got.get(count + i) == (i, 1) for i in range(pairs)) >= jaccard.TARGET * pairs
    assert len(got) <= 2 * pairs


def test_join_edges(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, "!!"), (4, "one two"), (5, "One, two!"), (6, long), (7, long + " end"), (None, "a b c d e f"),
            (None, "a b c d e f"), (9, "a b c d e f"), (10, "x y z x y z x"), (10, "p q r s t u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS n", "3 AS sig", "4 AS rep")
    got = sorted(((r.doc_id or 0, r.class_id, r.n_links, r.n_text_links) for r in jaccard.join_documents(docs).collect()), key=str)
    assert got == sorted([(1, 1, 0, 0), (2, 2, 0, 0), (3, 3, 0, 0), (4, 4, 1, 0), (5, 4, 1, 0), (6, 6, 1, 1), (7, 6, 1, 1),
                          (0, 9, 2, 0), (0, 9, 2, 0), (9, 9, 2, 0), (10, 10, 0, 0), (10, 10, 0, 0)], key=str)
    kept = sorted((r.doc_id, (r.text or "")[:9]) for r in jaccard.one_of_each_class(docs).collect())
    assert kept == [(1, ""), (2, ""), (3, "!!"), (4, "one two"), (6, "w0 w1 w2 "), (9, "a b c d e"), (10, "p q r s t"),
                    (10, "x y z x y")]
    assert jaccard.join_documents(docs.where("false")).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (500, 501), (501, 500)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 500: 500, 501: 500}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def edit_distance_inside(pattern, text):
    row = [0] * (len(text) + 1)
    for j, p in enumerate(pattern):
        new = [j + 1]
        for i, c in enumerate(text):
            new.append(min(row[i] + (p != c), row[i + 1] + 1, new[i] + 1))
        row = new
    return min(row)


def normal(text):
    return " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split())


def test_decontamination_agrees_with_full_alignment(spark):
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("abcdeiou") for _ in range(draw.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(draw.randint(8, 30)))) for i in range(12)]
    docs, want = [], {}
    for d in range(80):
        text = [word() for _ in range(40)]
        if d % 2:
            passage = list(draw.choice(items)[1])
            for _ in range(draw.randint(0, len(passage) // 7)):
                at = draw.randrange(len(passage))
                passage[at:at + draw.randint(0, 1)] = draw.choice("xyz")
            text.insert(draw.randint(0, 40), "".join(passage).upper() + "!!")
        docs.append((d, " ".join(text)))
        for i, t in items:
            e = edit_distance_inside(normal(t), normal(docs[-1][1]))
            if e <= int(0.1 * len(normal(t))):
                want[d, i] = e
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = df.withColumn("m", decontaminate.matches(df, bench)).collect()
    got = {(r.doc_id, m.item_id): m.edits for r in rows for m in r.m}
    assert got == want and len(want) > 20
    for r in rows:
        for m in r.m:
            region = normal(r.text[m.begin:m.end])
            assert edit_distance_inside(normal(dict(items)[m.item_id]), region) == m.edits


def test_decontamination_query_finds_all_whole_passages(spark):
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op2_qgram_decontamination"](spark, MEDIUM).collect()}
    docs = [(r.doc_id, normal(r.text)) for r in table(spark, MEDIUM, "documents").collect()]
    want = {(d, b.item_id) for b in table(spark, MEDIUM, "benchmark").collect() for d, t in docs if normal(b.text) in t}
    assert want and want <= got and len(got) <= len(want) + 2


def test_decontamination_edges(spark, monkeypatch):
    passage = "the quick brown fox jumps over the lazy dog again"
    rows = [(1, None), (2, ""), (3, passage), (3, passage), (None, "x" * 50_000 + " " + passage), (5, passage[:20]), (6, "ab" * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS edits")
    bench = spark.createDataFrame([(7, passage), (7, passage), (8, None), (None, passage), (9, "short"), (10, ""), (11, "ab" * 200),
                                   (12, (passage + " ") * 60)], "item_id long, text string")
    found = lambda b: sorted((r.doc_id or 0, m.item_id) for r in docs.withColumn("m", decontaminate.matches(docs, b)).collect()
                             for m in r.m)
    assert found(bench) == [(0, 7), (3, 7), (3, 7), (6, 11)]
    assert found(bench.where("false")) == []
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)
    assert found(bench) == [(0, 7), (3, 7), (3, 7), (6, 11)]
    assert docs.where("false").withColumn("m", decontaminate.matches(docs, bench)).count() == 0


def test_one_hit_for_texts_of_one_item_in_several_blocks(spark, monkeypatch):
    draw = random.Random(8)
    texts = [" ".join(f"{draw.randrange(10 ** 8)}" for _ in range(12)) for _ in range(6)]
    docs = spark.createDataFrame([(1, " and ".join(texts)), (2, texts[3]), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(i // 5, t) for i, t in enumerate(texts)], "item_id long, text string")
    hits = lambda: {r.doc_id: r.m for r in docs.withColumn("m", decontaminate.matches(docs, bench)).collect()}
    want = hits()
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)
    assert hits() == want and [m.item_id for m in want[1]] == [0, 1] and [m.item_id for m in want[2]] == [0]


def plain_pack(lengths, capacities):
    """Best fit with open bins looked through one by one."""
    bins, out, rest = [], [], sum(lengths)
    for n in lengths:
        fits = [b for b in bins if b[0] - b[1] >= n and b[0] > b[1]]
        if fits:
            room = min(b[0] - b[1] for b in fits)
            chosen = [b for b in fits if b[0] - b[1] == room][-1:]
        else:
            c = min((c for c in capacities if c >= n), key=lambda c: (packing.cost(c) / min(c, rest), c))
            chosen = [[c, 0]]
            bins += chosen
        chosen[0][1] += n
        rest -= n
    return sum(packing.cost(min(c for c in capacities if c >= b[1])) for b in bins), len(bins)


def test_packing_agrees_with_plain_best_fit():
    draw = np.random.default_rng(4)
    capacities = (64, 128, 256)
    lengths = np.sort(draw.integers(1, 257, 400))[::-1]
    chosen, cost = packing.pack(lengths, capacities)
    want, bins = plain_pack(lengths.tolist(), capacities)
    assert cost == pytest.approx(want, rel=0.01) and abs(int(chosen.max()) + 1 - bins) <= 2
    joint, used, fitted = packing.pack_jointly(lengths, capacities)
    assert (used <= fitted).all() and packing.cost(fitted).sum() <= cost + 1e-9
    assert used.sum() == lengths.sum() and (np.bincount(joint, lengths) == used).all()
    assert packing.cost(fitted).sum() < 1.15 * lengths.sum() / 256 * packing.cost(256)


def check_packing(rows, lengths, capacities):
    pieces = defaultdict(list)
    bins = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length))
        bins[r.bin_id].append(r)
    total = Counter()
    for d, n in lengths:
        total[d] += max(0, n or 0)
    assert {d: sum(n for _, n in p) for d, p in pieces.items()} == dict(total)
    for own in bins.values():
        own.sort(key=lambda r: r.place)
        assert [r.place for r in own] == list(range(len(own)))
        assert [r.offset for r in own] == np.concatenate([[0], np.cumsum([r.length for r in own])[:-1]]).tolist()
        used = sum(r.length for r in own)
        assert {r.used for r in own} == {used}
        assert {r.capacity for r in own} == {min(c for c in capacities if c >= used)}


def test_packing_query_and_edges(spark):
    from pyspark.sql import functions as F

    lengths = [(r.doc_id, r.n) for r in table(spark, MEDIUM, "documents").selectExpr("doc_id", "octet_length(text) + 1 AS n").collect()]
    check_packing(queries.QUERIES["op5_variable_best_fit"](spark, MEDIUM).collect(), lengths, packing.CAPACITIES)
    rows = [(1, 10), (1, 10), (None, 5), (2, None), (3, 0), (4, 1000), (5, 100), (6, 64)]
    df = spark.createDataFrame(rows, "doc_id long, length long").selectExpr("*", "1 AS piece", "'b' AS bin_id")
    for shard_rows in (3, 100):
        got = packing.pack_documents(df, F.col("length"), (100, 50), shard_rows=shard_rows).collect()
        check_packing(got, rows, (50, 100))
        assert len(got) == 7 + 10
    assert packing.pack_documents(df.where("false"), F.col("length")).count() == 0


def test_pipeline_stages_take_effect(spark):
    """Each stage on what the one before kept, against the plain versions."""
    docs = table(spark, MEDIUM, "documents").withColumn("extra", queries.F.lit(1)).cache()
    names = [n for n, _ in corpus_pipeline.STAGES]
    stage = dict(corpus_pipeline.STAGES)
    good = stage[names[0]](spark, docs, MEDIUM)
    assert good.columns == docs.columns
    label = {r.doc_id: r.quality for r in table(spark, MEDIUM, "labels").collect()}
    kept = {r.doc_id for r in good.collect()}
    assert sum(d in kept for d, q in label.items() if q) >= 0.98 * sum(label.values())
    assert sum(d in kept for d, q in label.items() if not q) <= 0.2 * sum(1 - q for q in label.values())
    one = stage[names[1]](spark, good, MEDIUM)
    assert one.columns == docs.columns
    want = plain_join([(r.doc_id, r.text) for r in good.collect()])
    assert {r.doc_id for r in one.collect()} == {i for i, (c, _) in want.items() if c == i}
    clean = stage[names[2]](spark, one, MEDIUM)
    bench = [normal(r.text) for r in table(spark, MEDIUM, "benchmark").collect()]
    left = {r.doc_id for r in clean.collect()}
    hit = {r.doc_id for r in one.collect() if any(b in normal(r.text) for b in bench)}
    assert clean.columns == docs.columns and not left & hit and one.count() - len(left) <= len(hit) + 2
    safe = stage[names[3]](spark, clean, MEDIUM)
    before = {r.doc_id: r for r in clean.collect()}
    assert safe.columns == docs.columns and safe.count() == len(before)
    changed = [r for r in safe.collect() if r.text != before[r.doc_id].text]
    assert changed and all("[secret]" in r.text and r.n_chars == len(r.text) for r in changed)
    packed = stage[names[4]](spark, safe, MEDIUM)
    check_packing(packed.collect(), [(r.doc_id, len(r.text.encode()) + 1) for r in safe.collect()], packing.CAPACITIES)


def test_stages_keep_columns_that_clash(spark):
    docs = spark.createDataFrame([(1, "x token=0123456789abcdef0123456789abcdef y"), (2, None)], "doc_id long, text string")
    docs = docs.selectExpr("*", "7 AS spans", "8 AS Spans_", "9 AS hits")
    stage = dict(corpus_pipeline.STAGES)
    clean = stage["benchmark decontamination"](spark, docs, SF_DIR)
    safe = stage["secret scans"](spark, clean, SF_DIR)
    assert safe.columns == docs.columns
    assert sorted(tuple(r) for r in safe.collect()) == [(1, "x [secret] y", 7, 8, 9), (2, None, 7, 8, 9)]


def test_pipeline_runs_on_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF_DIR, name).where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
