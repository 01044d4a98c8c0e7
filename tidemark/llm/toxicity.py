"""Toxicity by weak supervision.

Many voters look at a text: word lists in several languages, patterns, and words that labelled documents single out.
A generative model of the votes, fitted without labels by expectation and maximisation, estimates for every voter how
it votes on toxic and on clean texts, and from what is left after that how strongly voters go together; voters that
repeat each other count less. Its posterior labels train a linear classifier on the votes and word rates, and that
scores all texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Characters, Lazy, Words, crc_of_id, ship, small_batches, text_codes, text_udf, word_hash
from tidemark.llm.quality import labelled, sums
from tidemark.llm.trees import sigmoid

# The models are fitted on at most so many labelled documents, the first by a hash of their id.
TRAIN_ROWS = 20_000
ACCEPT = 0.3
# Words that labels single out: at most so many, found in so many toxic documents at least and in such a share of
# them, and so often toxic.
MINED, MINED_DOCS, MINED_PART, MINED_SHARE = 256, 3, 0.005, 0.85

# Word lists of the voters.
LEXICONS = {
    "mind": "idiot idiots moron morons stupid dumb imbecile imbeciles fool fools retard retarded brainless cretin",
    "filth": "trash scum garbage filth filthy vermin parasite parasites rat rats pig pigs",
    "worth": "worthless pathetic loser losers useless failure nobody",
    "disgust": "disgusting disgrace vile revolting repulsive sickening ugly gross",
    "mockery": "clown clowns joke laughable ridiculous",
    "profane": "damn crap bastard bastards bitch shit fuck fucking asshole",
    "hostile": "hate despise kill hurt destroy shut",
    "german": "dumm dummkopf trottel abschaum wertlos widerlich ekelhaft versager arschloch schwachkopf",
    "french": "imbécile débile ordure minable stupide crétin dégoûtant connard salaud abruti",
    "spanish": "estúpido estúpida basura patético inútil imbécil asqueroso idiota escoria payaso",
}
PATTERNS = ("second_person", "several", "dense", "shouted", "starred", "bangs", "no_hit_long", "no_hit_short")
VOTERS = (*LEXICONS, *PATTERNS, "mined", "mined_several", "mined_many", "mined_dense")
SECOND_PERSON = "you your youre u du dein dich tu ton toi votre tú tu eres"


def voter_words() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all listed words, sorted, and the number of their list."""
    pairs = sorted({(word_hash(w), i) for i, words in enumerate(LEXICONS.values()) for w in words.split()})
    return np.array([h for h, _ in pairs], np.uint64), np.array([i for _, i in pairs])


def among(hashes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the hashes that are known, and which they are; ``known`` is sorted."""
    if not len(known) or not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hit = np.flatnonzero(known[at] == hashes)
    return hit, at[hit]


def vote(texts: pa.Array, chars: Characters, listed: tuple[np.ndarray, np.ndarray], persons: np.ndarray,
         mined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes (1 toxic, -1 clean, 0 none), and rates of list and mined words, one row a text."""
    codes, starts = text_codes(texts)
    words = Words(codes, starts, chars)
    n = len(starts) - 1
    counts = np.diff(words.offsets)
    owner = np.repeat(np.arange(n), counts)
    hit, which = among(words.hash, listed[0])
    by_list = np.zeros((n, len(LEXICONS)))
    np.add.at(by_list, (owner[hit], listed[1][which]), 1)
    hits = by_list.sum(axis=1)
    mined_hit, _ = among(words.hash, mined)
    by_mined = np.bincount(owner[mined_hit], minlength=n)
    you = np.zeros(len(owner) + 4, bool)
    you[among(words.hash, persons)[0]] = True
    near = np.bincount(owner[hit], you[hit + 1] | you[np.maximum(hit - 1, 0)] | you[np.maximum(hit - 2, 0)], n)
    up = np.concatenate([[0], np.cumsum(chars.upper[codes])])
    shouted = np.bincount(owner[hit], up[words.end[hit]] - up[words.begin[hit]] == words.end[hit] - words.begin[hit], n)
    rate = hits / np.maximum(counts, 1) * 100
    starred = sums(codes == ord("*"), starts)
    bangs = sums(codes == ord("!"), starts)
    mined_rate = by_mined / np.maximum(counts, 1) * 100
    none = (hits == 0) & (by_mined == 0)
    plus = lambda on: np.where(on, 1, 0)
    votes = np.column_stack([
        plus(by_list > 0), plus(near > 0), plus(hits > 1), plus(rate > 1), plus(shouted > 0),
        plus((starred > 0) & (hits > 0)), plus((bangs > 3) & (hits > 0)),
        np.where(none & (counts >= 60), -1, 0), np.where(none & (counts < 60), -1, 0),
        plus(by_mined > 0), plus(by_mined > 1), plus(by_mined > 3), plus(mined_rate > 1)]).astype(np.int8)
    rates = np.column_stack([np.log1p(by_list), np.log1p(hits), np.log1p(rate), np.log1p(by_mined), np.log1p(mined_rate)])
    return votes, rates


class LabelModel:
    """Class-conditional vote tables by expectation and maximisation, with weights for voters that go together."""

    def __init__(self, votes: np.ndarray, prior: float, rounds: int = 25) -> None:
        kinds = np.stack([votes == k for k in (-1, 0, 1)]).astype(float)  # kind, row, voter
        # Voters that say nearly the same on all rows are one voter from the start.
        twins = self.together(votes - votes.mean(axis=0))
        twins = np.where(twins > 0.9, twins, 0)
        self.weight = 1 / (1 + twins.sum(axis=1))
        p = sigmoid(3.0 * (votes.clip(0) * self.weight).sum(axis=1) + 1.5 * (votes.clip(max=0) * self.weight).sum(axis=1)
                    + np.log(prior / (1 - prior)))
        for step in range(rounds):
            toxic = np.einsum("krv,r->kv", kinds, p) + 0.5
            clean = np.einsum("krv,r->kv", kinds, 1 - p) + 0.5
            self.tables = np.log(toxic / toxic.sum(axis=0)), np.log(clean / clean.sum(axis=0))
            # What the votes share beyond the label: correlation of their residuals.
            left = votes - (p[:, None] * (kinds * p[None, :, None]).sum(axis=1)[2] / max(p.sum(), 1e-9)
                            + (1 - p)[:, None] * (kinds * (1 - p)[None, :, None]).sum(axis=1)[2]
                            / max((1 - p).sum(), 1e-9))
            self.correlation = self.together(left - left.mean(axis=0))
            strong = np.maximum(np.where(self.correlation > 0.2, self.correlation, 0), twins)
            self.weight = 1 / (1 + strong.sum(axis=1))
            ratio = np.einsum("krv,kv->r", kinds, (self.tables[0] - self.tables[1]) * self.weight)
            p = sigmoid(ratio + np.log(prior / (1 - prior)))
        self.posterior = p
        self.accuracy = np.exp(self.tables[0][2]), np.exp(self.tables[1][2])

    @staticmethod
    def together(left: np.ndarray) -> np.ndarray:
        """Absolute correlation of columns; 0 with themselves."""
        size = np.sqrt((left ** 2).sum(axis=0))
        out = np.abs(left.T @ left) / np.maximum(np.outer(size, size), 1e-9)
        np.fill_diagonal(out, 0)
        return out


def fit_linear(x: np.ndarray, p: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression on soft labels, by Newton steps; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-3
    for _ in range(rounds):
        q = sigmoid(x @ w)
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + np.diag(keep), x.T @ (p - q) - keep * w)
        w = w + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


def design(votes: np.ndarray, rates: np.ndarray) -> np.ndarray:
    return np.column_stack([votes > 0, votes < 0, rates]).astype(float)


def mine_words(sample: DataFrame, toxic_rows: int) -> np.ndarray:
    """Hashes of words that are frequent in toxic labelled texts and rare in clean ones; counted by Spark."""
    held = Lazy(Characters)

    def count(batches):
        for batch in batches:
            codes, starts = text_codes(batch.column("text"))
            words = Words(codes, starts, held())
            toxic = batch.column("y").to_numpy(zero_copy_only=False)
            parts = [np.unique(words.hash[a:b]) for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True)]
            sizes = [len(x) for x in parts]
            if sum(sizes):
                found, back, n = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
                bad = np.bincount(back, np.repeat(toxic, sizes), len(found)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(bad)],
                                                 names=["h", "n", "bad"])

    rows = (sample.select(F.coalesce("text", F.lit("")).alias("text"), "y").dropDuplicates()
            .mapInArrow(count, "h bigint, n bigint, bad bigint").groupBy("h").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
            .where((F.col("bad") >= max(MINED_DOCS, MINED_PART * toxic_rows)) & (F.col("bad") >= MINED_SHARE * F.col("n")))
            .orderBy(F.desc("bad"), "h").limit(MINED).collect())
    return np.sort(np.array([r.h for r in rows], np.int64).view(np.uint64))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict:
    """Classifier from labelled documents whose crc32 of the id, modulo 4, is not 2.

    Labels choose the mined words and give the share of toxic texts; the classifier's targets are the label model's.
    Without labelled documents the given lists alone decide.
    """
    spark = docs.sparkSession
    small_batches(spark)
    chosen = labelled(labels, "toxic", rows, crc_of_id() % 4 != 2)
    sample = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .join(F.broadcast(chosen), "doc_id").select("text", "y"))  # bounded: ``rows`` ids
    listed, persons = voter_words(), np.sort(np.array([word_hash(w) for w in SECOND_PERSON.split()], np.uint64))
    model = {"listed": listed, "persons": persons, "mined": mine_words(sample, chosen.where("y = 1").count())}
    held = Lazy(Characters)

    def work(texts):
        votes, rates = vote(texts, held(), listed, persons, model["mined"])
        both = np.column_stack([votes, rates])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(both) + 1) * both.shape[1], pa.int32()), pa.array(both.ravel()))

    found = sample.select("y", text_udf(work, "array<double>")("text").alias("x")).orderBy("x", "y").limit(rows).collect()
    if found:
        both = np.array([r.x for r in found])
        y = np.array([r.y for r in found])
    else:  # made up: clean texts, and toxic ones with a vote of each list, so that the lists alone decide
        both = np.zeros((400 + 40 * len(LEXICONS), len(VOTERS) + len(LEXICONS) + 4))
        both[400:, :len(LEXICONS)] = np.repeat(np.eye(len(LEXICONS)), 40, axis=0)
        y = (np.arange(len(both)) >= 400).astype(int)
    votes, rates = both[:, :len(VOTERS)].astype(int), both[:, len(VOTERS):]
    labels_of = LabelModel(votes, float((y.sum() + 0.5) / (len(y) + 1)))
    target = labels_of.posterior if found else y
    return model | {"weights": fit_linear(design(votes, rates), target), "voters": labels_of.accuracy,
                    "correlation": labels_of.correlation}


def score_of(df: DataFrame, model: dict, text: Column | str = "text") -> Column:
    """Probability of toxicity of a text column; null and empty texts have one too."""
    small_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(
        {k: model[k] for k in ("listed", "persons", "mined", "weights")})  # bounded: the lists and MINED words
    held = Lazy(Characters)

    def work(texts):
        m = sent.value
        x = design(*vote(texts, held(), m["listed"], m["persons"], m["mined"]))
        return pa.array(sigmoid(x @ m["weights"][:-1] + m["weights"][-1]))

    return text_udf(work, "double")(F.col(text).cast("string") if isinstance(text, str) else text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``; repeated rows come out as often."""
    rows = docs.select(F.col("doc_id"), score_of(docs, train(docs, labels)).alias("score"))
    return rows.select("doc_id", (crc_of_id() % 4 == 2).alias("held_out"), "score",
                       F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"))


ship(__name__)
