"""Quality of documents: gradient-boosted trees over statistics of the whole text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import trees
from tidemark.llm.common import Characters, Lazy, Words, crc_of_id, hash_sample, ship, small_batches, text_codes, text_udf

# The trees learn from at most so many labelled documents, the first by a hash of their id.
TRAIN_ROWS = 20_000
ACCEPT = 0.3

FEATURES = ("log_chars", "log_words", "word_length", "letters", "upper", "digits", "spaces", "newlines", "pipes", "marks",
            "exclaim", "other_symbols", "distinct_words", "top_word", "same_as_before", "chars_per_line",
            "symbols_after_words", "upper_words")


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.float64)])[starts])


def statistics(texts: pa.Array, chars: Characters) -> np.ndarray:
    """One row of ``FEATURES`` for each text; null is empty, and an empty text has zeros."""
    codes, starts = text_codes(texts)
    words = Words(codes, starts, chars)
    n = np.diff(starts).astype(float)
    some = np.maximum(n, 1)
    w = np.diff(words.offsets).astype(float)
    some_w = np.maximum(w, 1)
    letter = chars.letter[codes]
    upper = sums(chars.upper[codes], starts)
    space, digit = chars.space[codes], chars.digit[codes]
    symbol = ~(letter | space | digit)
    newlines = sums(codes == 10, starts)
    owner = np.repeat(np.arange(len(n)), np.diff(words.offsets))
    # Words by text, equal ones next to each other: the text's number above a part of the hash.
    keys = np.sort((owner.astype(np.uint64) << np.uint64(44)) | (words.hash >> np.uint64(20)))
    head = np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)]
    of = (keys[head] >> np.uint64(44)).astype(np.int64)
    run = np.diff(np.concatenate([np.flatnonzero(head), [len(keys)]]))
    top = np.zeros(len(n))
    np.maximum.at(top, of, run)
    distinct = np.bincount(of, minlength=len(n))
    same = np.concatenate([[False], (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])])[:len(owner)]
    padded = np.concatenate([symbol, [False]])
    after = padded[words.end]
    shout = np.zeros(len(owner))
    if len(owner):
        shout = np.diff(np.concatenate([[0], np.cumsum(chars.upper[codes])])[np.stack([words.begin, words.end])], axis=0)[0]
        shout = shout == words.end - words.begin
    return np.stack([
        np.log1p(n), np.log1p(w), np.bincount(owner, words.end - words.begin, len(n)) / some_w,
        sums(letter, starts) / some, upper / np.maximum(1, sums(letter, starts)), sums(digit, starts) / some,
        sums(space, starts) / some, newlines / some, sums(codes == ord("|"), starts) / some_w,
        sums(np.isin(codes, np.array([ord(c) for c in "#$%&*@^~"], np.uint32)), starts) / some_w,
        sums(codes == ord("!"), starts) / some_w, sums(symbol, starts) / some, distinct / some_w, top / some_w,
        np.bincount(owner, same, len(n)) / some_w, np.log1p(n / (newlines + 1)),
        np.bincount(owner, after, len(n)) / some_w, np.bincount(owner, shout, len(n)) / some_w], axis=1)


def labelled(labels: DataFrame, column: str, rows: int, chosen: Column) -> DataFrame:
    """``doc_id, y`` of a bounded sample of labelled ids; an id with several labels has their rounded mean."""
    one_each = (labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & chosen)
                .groupBy("doc_id").agg(F.when(F.avg(column) >= 0.5, 1).otherwise(0).alias("y")))
    return hash_sample(one_each, F.col("doc_id"), rows)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict:
    """A model from labelled documents whose crc32 of the id, modulo 5, is not 0."""
    small_batches(docs.sparkSession)
    held = Lazy(Characters)

    def work(texts):
        x = statistics(texts, held())
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))

    sample = labelled(labels, "quality", rows, crc_of_id() % 5 != 0)
    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .join(F.broadcast(sample), "doc_id")  # bounded: ``rows`` ids
             .select("y", text_udf(work, "array<double>")("text").alias("x"))
             .orderBy("x", "y").limit(rows).collect())  # bounded also where ids repeat
    x = np.array([r.x for r in found]).reshape(len(found), len(FEATURES))
    return trees.fit(x, np.array([r.y for r in found], float))


def score_of(df: DataFrame, model: dict, text: Column | str = "text") -> Column:
    """Probability of good quality of a text column; null and empty texts have one too."""
    small_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)  # bounded: TREES * 2 ** DEPTH
    held = Lazy(Characters)

    def work(texts):
        return pa.array(trees.score(sent.value, statistics(texts, held())))

    return text_udf(work, "double")(F.col(text).cast("string") if isinstance(text, str) else text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``; repeated rows come out as often."""
    rows = docs.select(F.col("doc_id"), score_of(docs, train(docs, labels)).alias("score"))
    return rows.select("doc_id", (crc_of_id() % 5 == 0).alias("held_out"), "score",
                       F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"))


ship(__name__)
