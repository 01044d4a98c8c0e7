"""Language by cross-parsing: how few phrases of known text does a text fall into?

One suffix automaton per language holds every substring of a sample of labelled text. A text is parsed greedily into
longest matches from the automaton; the phrases, times the logarithm of the sample's length, per character, estimate
its cross entropy with the language, and the least wins. Parsing is one table lookup a character. Texts are cut into
lanes of ``LANE`` characters, and all lanes of a block and all languages go through the table in step, so a long text
costs no more than many short ones; a cut adds at most one phrase to every language alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Characters, Lazy, crc_of_id, in_blocks, ship, small_batches, text_codes

# The sample: at most so many documents and characters of each, and so many characters in all, per language.
SAMPLE_DOCS, SAMPLE_CHARS_EACH, SAMPLE_CHARS = 300, 1500, 32_000
# Languages are the most frequent labels, at most so many.
MAX_LANGUAGES = 64
LANE = 512
UNKNOWN = "und"


def normal_codes(codes: np.ndarray, starts: np.ndarray, chars: Characters) -> tuple[np.ndarray, np.ndarray]:
    """Folded letters; each run of other characters is one space. Every text starts with a space."""
    chars.learn(codes)
    letter = chars.letter[codes]
    folded = np.where(letter, chars.fold[codes], np.uint32(32))
    first = np.zeros(len(codes), bool)
    first[starts[:-1][starts[:-1] < len(codes)]] = True
    keep = letter | np.concatenate([[True], letter[:-1]])[:len(codes)] | first
    kept = np.concatenate([[0], np.cumsum(keep)])
    return folded[keep], kept[starts]


class SuffixAutomaton:
    """All substrings of a text; states in order of making, each with its moves."""

    def __init__(self, text: list[int]) -> None:
        self.moves: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            moves = self.moves
            new = len(moves)
            moves.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in moves[p]:
                moves[p][c] = new
                p = link[p]
            if p >= 0:
                q = moves[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    copy = len(moves)
                    moves.append(dict(moves[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and moves[p].get(c) == q:
                        moves[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new


class CrossParser:
    """Automata of all languages in one table of moves; state 0 means no move."""

    def __init__(self, samples: dict[str, str]) -> None:
        chars = Characters()
        self.languages = sorted(samples)
        texts = []
        for name in self.languages:
            codes, starts = text_codes(pa.array([samples[name]]))
            texts.append(normal_codes(codes, starts, chars)[0])
        self.alphabet = np.unique(np.concatenate([np.array([32], np.uint32), *texts]))
        rows = [np.zeros((1, len(self.alphabet) + 1), np.int32)]
        self.roots, self.weights, base = [], [], 1
        for text in texts:
            moves = SuffixAutomaton(np.searchsorted(self.alphabet, text).tolist()).moves
            part = np.zeros((len(moves), len(self.alphabet) + 1), np.int32)
            for state, row in enumerate(moves):
                for c, to in row.items():
                    part[state, c] = to + base
            rows.append(part)
            self.roots.append(base)
            self.weights.append(np.log2(max(2, len(text))))
            base += len(moves)
        self.table = np.concatenate(rows)

    def entropies(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits per character, one row a text and one column a language, of normalised texts."""
        n_texts, n_lang = len(starts) - 1, len(self.languages)
        lengths = np.diff(starts)
        pieces = np.maximum(1, -(-lengths // LANE))
        owner = np.repeat(np.arange(n_texts), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = starts[owner] + nth * LANE
        size = np.minimum(LANE, starts[owner + 1] - begin)
        order = np.argsort(-size, kind="stable")
        begin, size, owner = begin[order], size[order], owner[order]
        known = np.zeros(0x110000, np.int32)
        known[:] = len(self.alphabet)
        known[self.alphabet] = np.arange(len(self.alphabet))
        symbols = known[codes]
        width = self.table.shape[1]
        flat = self.table.ravel()
        roots = np.array(self.roots, np.int32)[:, None]
        state = np.repeat(roots, len(begin), axis=1)
        phrases = np.zeros(state.shape, np.int32)
        active = len(begin)
        top = int(size[0]) if len(size) else 0
        for step in range(top):
            while active and size[active - 1] <= step:
                active = int(np.searchsorted(-size[:active], -step, side="left"))
            now = symbols[begin[:active] + step]
            to = flat.take(state[:, :active] * width + now)
            fail = to == 0
            # A phrase ends; the character starts the next one, or is a phrase of its own if the language lacks it.
            again = flat.take(roots * width + now)
            phrases[:, :active] += fail & (state[:, :active] != roots)
            phrases[:, :active] += fail & (again == 0)
            state[:, :active] = np.where(fail, np.maximum(again, roots), to)
        phrases += state != roots
        sums = np.stack([np.bincount(owner, weights=phrases[i], minlength=n_texts) for i in range(n_lang)], axis=1)
        return sums * np.array(self.weights) / np.maximum(1, lengths)[:, None]


def language_samples(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> dict[str, str]:
    """Bounded labelled text of each language: the first documents by a hash of their text."""
    rows = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null and text rlike '\\\\p{L}'")
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    samples: dict[str, str] = {}
    if counts:
        # The hash is cut by each language's count first, so that a task passes on its share only.
        share = F.create_map(*[F.lit(x) for r in counts for x in (r.lang, int((1 << 20) * min(1, 2 * SAMPLE_DOCS / r["count"])) + 1)])
        order = Window.partitionBy("lang").orderBy("h")  # about 2 * SAMPLE_DOCS rows of a language
        picked = (rows.withColumn("h", F.xxhash64("text"))
                  .where(F.pmod("h", F.lit(1 << 20)) < F.try_element_at(share, F.col("lang")))
                  .select("lang", "h", F.substring("text", 1, SAMPLE_CHARS_EACH).alias("text"))
                  .dropDuplicates(["lang", "h"])
                  .withColumn("r", F.row_number().over(order)).where(F.col("r") <= SAMPLE_DOCS))
        for r in picked.orderBy("lang", "r").collect():  # bounded: MAX_LANGUAGES * SAMPLE_DOCS texts
            held = samples.get(r.lang, "")
            if len(held) < SAMPLE_CHARS:
                samples[r.lang] = (held + " " + r.text)[:SAMPLE_CHARS]
    return samples


def predict(docs: DataFrame, samples: dict[str, str], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, bits``: language of every whole text, and its share against the others.

    Null text, text without a letter, and any text when nothing was learnt is ``und`` with score 0. Equal entropies go
    to the language that is first by name. Repeated rows come out as often; only id and text are read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    # Plain values travel, so that workers need not know the class by name.
    sent = spark.sparkContext.broadcast(vars(CrossParser(samples)) if samples else None)  # bounded: MAX_LANGUAGES * SAMPLE_CHARS
    held = Lazy(Characters)

    def work(block: pa.Table):
        parser = None
        if sent.value is not None:
            parser = CrossParser.__new__(CrossParser)
            vars(parser).update(sent.value)
        codes, starts = text_codes(block.column("text"))
        folded, places = normal_codes(codes, starts, held())
        n = block.num_rows
        letters = np.diff(np.concatenate([[0], np.cumsum(folded != 32)])[places])
        name = np.full(n, UNKNOWN, object)
        score, bits = np.zeros(n), np.zeros(n)
        some = letters > 0
        if parser is not None and some.any():
            h = parser.entropies(folded, places)
            best = h.argmin(axis=1)
            share = np.exp2(-(h - h.min(axis=1, keepdims=True)) * 4)
            score[some] = (1 / share.sum(axis=1))[some]
            bits[some] = h.min(axis=1)[some]
            name[some] = np.array(parser.languages, object)[best[some]]
        return pa.RecordBatch.from_arrays(
            [block.column("doc_id").combine_chunks(), pa.array(name, pa.string()), pa.array(score), pa.array(bits)],
            names=["doc_id", "lang_pred", "score", "bits"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(in_blocks(work, "text"), "doc_id bigint, lang_pred string, score double, bits double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from documents whose crc32 of the id, modulo 4, is not 2, and predict all."""
    out = crc_of_id() % 4 == 2
    return (predict(docs, language_samples(docs.where(~out)))
            .select("doc_id", out.alias("held_out"), "lang_pred", "score", "bits"))


ship(__name__)
