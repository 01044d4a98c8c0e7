"""Marginal likelihood of texts over all their segmentations into pieces of an existing vocabulary and known words.

A word, with a mark before it, is a lattice: every piece that matches somewhere is an arc, and characters that are no
piece have an arc of bytes. A forward recursion in logarithms adds up all ways through it. The scores that the vocabulary
file comes with weigh the arcs at first; expected counts over the different words of the training texts then set them.
Over the lattice of pieces lie arcs for whole words that the training texts hold, discounted so that the pieces keep the
mass of what is new; a language's own counts stand before those of all languages. No piece goes beyond a word, so the
recursion over a document is a product of its words' sums. The language l is summed over as well, one of them being all
languages together:

    P(text) = sum over l of share(l) * product over words of P(word | l), times the chances of going on and of ending

    P(word | l) = (c_l - d_l) / N_l + d_l V_l / N_l * (OTHER * P(word) + (1 - OTHER) * sum over segmentations, weights of l)
    P(word)     = (c - d) / N + d V / N * sum over segmentations, weights of all languages

where a word that some training text holds is spelled with the weights of all languages in both lines.

Texts are cut into blocks. A block sends each of its different words to the counts once and gets its figures back, so
neither a list of words nor a group of texts has to fit anywhere: only the piece weights go to all tasks, as many for each
language as the vocabulary file has pieces.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, crc_of_id, kept, ship, small_batches, text_codes
from tidemark.llm.wordblocks import byte_set, word_block

SPACES = byte_set(" \t\n\x0b\x0c\r")
END = "\n"  # the end of a text; no word holds it
MARK = 0x110000  # stands before a word; no character has this code
# Bytes of the texts that share one list of words.
BLOCK_BYTES = 8 << 20
# Words of one row of such a list.
LIST_WORDS = 1 << 13
# Characters whose lattices are worked on together.
LATTICE_CHARS = 1 << 17
# Passes that set the piece weights, and the counts that the file's own scores stand for.
PASSES, PRIOR_COUNTS = 3, 200.0
# Of what a language does not know, the share that others may.
OTHER = 0.1


@dataclass
class Pieces:
    """A vocabulary as a tree of characters, with the logarithm of each piece's weight.

    ``first`` leads from a character to the node of depth one, ``keys`` and ``to`` (sorted) from a node and a character to
    the next, ``piece`` is the piece that ends at a node, or -1. ``byte`` has the piece of every byte.
    """

    first: np.ndarray
    keys: np.ndarray
    to: np.ndarray
    piece: np.ndarray
    byte: np.ndarray
    longest: int
    weight: np.ndarray


def read_pieces(path: str, ranked: bool = True) -> Pieces:
    """Pieces of a sentencepiece file that can stand in lower-cased words.

    Scores of a ``ranked`` vocabulary fall by one a piece and say its rank r, which weighs 1 / (1 + r); others are
    logarithms of weights. Bytes weigh as much as the least piece.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names, scores, byte = [], [], np.zeros(256, np.int64)
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            byte[int(name[3:5], 16)] = len(names)
            names.append("")
            scores.append(np.nan)
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            plain = name.lstrip("▁")
            marks = len(name) - len(plain)
            if marks > 1 or "▁" in plain or any("A" <= c <= "Z" for c in plain):
                continue
            names.append(name)
            scores.append(model.get_score(i))
    if "▁" not in names:  # a word may start with any character
        names.append("▁")
        scores.append(np.nan)
    scores = np.array(scores)
    weight = 1 / (1 + np.nanmax(scores) - scores) if ranked else np.exp(scores)
    weight = np.where(np.isnan(weight), np.nanmin(weight), weight)
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for index, name in enumerate(names):
        node = 0
        for place, char in enumerate(name):
            code = MARK if place == 0 and char == "▁" else ord(char)
            if code not in children[node]:
                children[node][code] = len(children)
                children.append({})
                ends.append(-1)
            node = children[node][code]
        if name:
            ends[node] = index
    first = np.full(MARK + 1, -1, np.int32)
    for code, node in children[0].items():
        first[code] = node
    edges = sorted((node << 21 | code, to) for node, below in enumerate(children) if node for code, to in below.items())
    keys, to = (np.array(x, np.int64) for x in zip(*edges, strict=True))
    return Pieces(first, keys, to, np.array(ends, np.int64), byte, max(map(len, names)), np.log(weight / weight.sum()))


class Lattices:
    """Arcs of some words: ``scores[l - 1, p]`` of the piece of l characters at place p, -inf where there is none."""

    def __init__(self, words: list[str], pieces: Pieces) -> None:
        self.pieces = pieces
        # Longest first, so that the words that are open at a step come first.
        self.order = np.argsort([-len(w) for w in words], kind="stable")
        sorted_words = [words[i] for i in self.order]
        codes, _ = text_codes(pa.array(["\0" + w + "\0" for w in sorted_words]))
        self.sizes = np.array([len(w) + 1 for w in sorted_words], np.int64)
        # One place more a word than it has characters: the last is where it ends.
        self.begin = np.concatenate([[0], np.cumsum(self.sizes + 1)])[:-1]
        codes = codes.astype(np.int64)
        codes[self.begin] = MARK
        self.total = len(codes)
        left = np.repeat(self.begin + self.sizes, self.sizes + 1) - np.arange(self.total)
        self.arcs: list[tuple[np.ndarray, np.ndarray]] = []
        at = np.flatnonzero(left > 0)
        node = pieces.first[codes[at]].astype(np.int64)
        at, node = at[node >= 0], node[node >= 0]
        for length in range(1, pieces.longest + 1):
            here = pieces.piece[node] >= 0
            self.arcs.append((at[here], pieces.piece[node[here]]))
            on = left[at] > length
            at, node = at[on], node[on]
            if not len(at):
                break
            key = node << 21 | codes[at + length]
            spot = np.minimum(np.searchsorted(pieces.keys, key), len(pieces.keys) - 1)
            found = pieces.keys[spot] == key
            at, node = at[found], pieces.to[spot[found]]
        # Characters without a piece of their own, in bytes.
        single = np.zeros(self.total, bool)
        single[self.arcs[0][0]] = True
        self.odd = np.flatnonzero((left > 0) & ~single & (codes != MARK))
        spelled = [chr(c).encode("utf-8", "surrogatepass") for c in codes[self.odd].tolist()]
        self.odd_size = np.array([len(b) for b in spelled], np.int64)
        self.odd_bytes = pieces.byte[np.frombuffer(b"".join(spelled), np.uint8)]

    def _scores(self, weight: np.ndarray) -> np.ndarray:
        out = np.full((len(self.arcs), self.total), -np.inf)
        for length, (at, piece) in enumerate(self.arcs):
            out[length, at] = weight[piece]
        if len(self.odd):
            ends = np.cumsum(self.odd_size)
            sums = np.concatenate([[0], np.cumsum(weight[self.odd_bytes])])
            out[0, self.odd] = sums[ends] - sums[ends - self.odd_size]
        return out

    def _open(self, step: int) -> int:
        """How many words have a place ``step``."""
        return int(np.searchsorted(-self.sizes, -step, side="right"))

    def forward(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logarithm of the sum over all ways to each place, and the arcs' scores."""
        scores = self._scores(weight)
        alpha = np.full(self.total, -np.inf)
        alpha[self.begin] = 0
        for step in range(1, int(self.sizes[0]) + 1 if len(self.sizes) else 0):
            at = self.begin[:self._open(step)] + step
            ways = np.stack([alpha[at - k] + scores[k - 1, at - k] for k in range(1, min(step, len(scores)) + 1)])
            most = ways.max(0)
            safe = np.where(np.isfinite(most), most, 0)
            with np.errstate(divide="ignore"):
                alpha[at] = np.log(np.exp(ways - safe).sum(0)) + safe
        return alpha, scores

    def marginal(self, weight: np.ndarray) -> np.ndarray:
        """Natural logarithm of each word's probability, in the words' own order."""
        alpha, _ = self.forward(weight)
        out = np.zeros(len(self.order))
        out[self.order] = alpha[self.begin + self.sizes]
        return out

    def expected(self, weight: np.ndarray) -> np.ndarray:
        """How often each piece is used on average over all ways, all words together."""
        alpha, scores = self.forward(weight)
        beta = np.full(self.total, -np.inf)
        beta[self.begin + self.sizes] = 0
        whole = np.repeat(alpha[self.begin + self.sizes], self.sizes + 1)
        for back in range(1, int(self.sizes[0]) + 1 if len(self.sizes) else 0):
            n = self._open(back)
            at = self.begin[:n] + self.sizes[:n] - back
            ways = np.stack([scores[k - 1, at] + beta[at + k] for k in range(1, min(back, len(scores)) + 1)])
            most = ways.max(0)
            safe = np.where(np.isfinite(most), most, 0)
            with np.errstate(divide="ignore"):
                beta[at] = np.log(np.exp(ways - safe).sum(0)) + safe
        out = np.zeros(len(weight))
        for length, (at, piece) in enumerate(self.arcs):
            np.add.at(out, piece, np.exp(alpha[at] + scores[length, at] + beta[at + length + 1] - whole[at]))
        if len(self.odd):
            used = np.exp(alpha[self.odd] + scores[0, self.odd] + beta[self.odd + 1] - whole[self.odd])
            np.add.at(out, self.odd_bytes, np.repeat(used, self.odd_size))
        return out


def _lattices(words: list[str], pieces: Pieces):
    """Lattices of a few words at a time."""
    at = 0
    while at < len(words):
        end, chars = at, 0
        while end < len(words) and (end == at or chars + len(words[end]) < LATTICE_CHARS):
            chars += len(words[end]) + 2
            end += 1
        yield Lattices(words[at:end], pieces)
        at = end


def _marginals(words: list[str], pieces: Pieces, weights: list[np.ndarray]) -> np.ndarray:
    """log10 of the words' probabilities, a column for each of the weights."""
    parts = [np.stack([x.marginal(w) for w in weights], 1) for x in _lattices(words, pieces)] if weights else []
    return np.concatenate(parts) / np.log(10) if parts else np.zeros((0, len(weights)))


def fitted_pieces(words: DataFrame, pieces: Pieces, langs: list[str], passes: int = PASSES) -> list[np.ndarray]:
    """Weights of pieces for each language, and for all together, from expected counts over ``words`` (lang, word).

    Each word of a language counts once. One sum for each language and piece reaches the driver.
    """
    spark = words.sparkSession
    start = np.exp(pieces.weight)
    weights = {lang: pieces.weight for lang in langs}
    for _ in range(passes):
        sent = spark.sparkContext.broadcast((pieces, weights))

        def count(batches, sent=sent):
            held, weights = sent.value
            total = {}
            for table in _gathered(batches):
                names = np.array(table.column("lang").to_pylist(), object)
                spelled = np.array(table.column("word").to_pylist(), object)
                for lang in set(names.tolist()):
                    if lang not in total:
                        total[lang] = np.zeros(len(held.weight))
                    for lattices in _lattices(spelled[names == lang].tolist(), held):
                        total[lang] += lattices.expected(weights[lang])
            for lang, sums in total.items():
                some = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), pa.array(some, pa.int32()), pa.array(sums[some])],
                                                 names=["lang", "piece", "times"])

        sums = (words.select("lang", "word").mapInArrow(count, "lang string, piece int, times double").groupBy("lang", "piece")
                .agg(F.sum("times").alias("times"))).toArrow().to_pandas()
        everything = PRIOR_COUNTS * start
        for lang, own in sums.groupby("lang"):
            total = PRIOR_COUNTS * start
            total[own["piece"].to_numpy()] += own["times"].to_numpy()
            weights[lang] = np.log(total / total.sum())
            everything[own["piece"].to_numpy()] += own["times"].to_numpy()
    return [*(weights[lang] for lang in langs), np.log(everything / everything.sum()) if langs and passes else pieces.weight]


def _gathered(batches, rows: int = 1 << 14):
    """Tables of some more rows than a batch has."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield pa.Table.from_batches(held)
            held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


TOKENS = ("block bigint, doc_id bigint, train boolean, n bigint, steps array<int>, times array<int>, "
          "lang string, first int, words array<string>, counts array<bigint>")


def _cut(batches):
    """Rows for texts (their words as places in the block's list, each as a step from the last) and for word lists.

    A list holds the different words of each language apart, and the training occurrences of each.
    """
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for block in blocks(batches, "text", BLOCK_BYTES):
        found = word_block(block.column("text"), SPACES)
        n_texts, n_words = block.num_rows, len(found.words)
        # The end of a text is one more word.
        dictionary = pa.concat_arrays([found.words, pa.array([END])])
        text = np.concatenate([found.text, np.arange(n_texts)])
        code = np.concatenate([found.codes, np.full(n_texts, n_words)])
        langs = pc.fill_null(block.column("lang").cast(pa.string()), "und").combine_chunks().dictionary_encode()
        langs = langs.combine_chunks() if isinstance(langs, pa.ChunkedArray) else langs
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        train = block.column("train").to_numpy()
        pairs, place = np.unique(lang[text] * (n_words + 1) + code, return_inverse=True)
        counted = np.bincount(place, train[text].astype(float), minlength=len(pairs)).astype(np.int64)
        entries, times = np.unique(text * len(pairs) + place, return_counts=True)
        owner, places = entries // len(pairs), entries % len(pairs)
        steps = np.diff(places, prepend=0)
        bounds = np.searchsorted(owner, np.arange(n_texts + 1))
        steps[bounds[:-1]] = places[bounds[:-1]]
        at = pa.array(bounds, pa.int32())
        empty = lambda kind: pa.nulls(n_texts, kind)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(n_texts, number)), block.column("doc_id").combine_chunks(), block.column("train").combine_chunks(),
            pa.array(np.bincount(text, minlength=n_texts)), pa.ListArray.from_arrays(at, pa.array(steps.astype(np.int32))),
            pa.ListArray.from_arrays(at, pa.array(times.astype(np.int32))), empty(pa.string()), empty(pa.int32()),
            empty(pa.list_(pa.string())), empty(pa.list_(pa.int64()))], names=[f.split(" ")[0] for f in TOKENS.split(", ")])
        # Lists of a bounded number of words, none over two languages.
        cuts = np.unique(np.concatenate([np.searchsorted(pairs, np.arange(len(langs.dictionary)) * (n_words + 1)),
                                         np.arange(0, len(pairs), LIST_WORDS), [len(pairs)]]))
        lists, rows = pa.array(cuts, pa.int32()), len(cuts) - 1
        empty = lambda kind: pa.nulls(rows, kind)  # noqa: E731,B023
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(rows, number)), empty(pa.int64()), empty(pa.bool_()), empty(pa.int64()), empty(pa.list_(pa.int32())),
            empty(pa.list_(pa.int32())), langs.dictionary.take(pa.array(pairs[cuts[:-1]] // (n_words + 1))),
            pa.array(cuts[:-1], pa.int32()), pa.ListArray.from_arrays(lists, dictionary.take(pa.array(pairs % (n_words + 1)))),
            pa.ListArray.from_arrays(lists, pa.array(counted))], names=[f.split(" ")[0] for f in TOKENS.split(", ")])
        number += 1


@dataclass
class Figures:
    """What the counts of a language, or of all, come to: words, different words, and the discount."""

    n: int
    kinds: int
    discount: float

    @staticmethod
    def of(n: int, kinds: int, once: int, twice: int) -> Figures:
        return Figures(n, kinds, min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.5)

    @property
    def new(self) -> float:
        """Mass that the discount frees."""
        return self.discount * self.kinds / self.n if self.n else 1.0

    def known(self, counts: np.ndarray) -> np.ndarray:
        return np.maximum(counts - self.discount, 0) / self.n if self.n else np.zeros(len(counts))


def _figures(counts: DataFrame, *by: str) -> list:
    return counts.groupBy(*by).agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("kinds"), F.sum(F.expr("cast(c = 1 AS bigint)")).alias("once"),
        F.sum(F.expr("cast(c = 2 AS bigint)")).alias("twice")).collect()


def score_texts(docs: DataFrame, vocabulary: str, train, passes: int = PASSES) -> DataFrame:
    """``doc_id, train, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``docs`` has doc_id, text and lang, ``train`` is a boolean column of it: rows to learn from. A-Z count as lower case;
    words lie between white space, and each text has one end more. ``base_score`` is the sum over all tokens of
    log10((c + 1) / (N + V + 1)), ``score`` log10 of the text's marginal probability. Null texts are empty, and so is the
    end their only token; null languages are one of their own; repeated rows count each, null ids pass through. Without
    training rows the file's own weights score every word. Other columns are left alone; an empty table gives no rows.
    The languages, a few figures each, and the piece sums are all that reaches the driver.
    """
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"), F.coalesce(train, F.lit(False)).alias("train"))
    tokens = kept(rows.mapInArrow(_cut, TOKENS), "lattice-tokens", compression="zstd")
    listed = (tokens.where("words is not null")
              .select("block", "lang", "first", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w"))
              .select("block", (F.col("first") + F.col("at")).alias("place"), F.col("w.words").alias("word"), "lang",
                      F.col("w.counts").alias("c")))
    by_lang = listed.groupBy("word", "lang").agg(F.sum("c").alias("c"))
    words = kept(by_lang.groupBy("word").agg(
        F.sum("c").alias("c"), F.expr("collect_list(struct(lang, c)) FILTER (WHERE c > 0)").alias("own")), "lattice-words",
        compression="zstd")
    seen = words.where("c > 0")
    plain = seen.where(F.col("word") != END)
    everywhere = Figures.of(*(x or 0 for x in _figures(plain)[0]))
    each = plain.select(F.explode("own").alias("o")).select("o.lang", "o.c")
    langs = {r.lang: Figures.of(r.n, r.kinds, r.once, r.twice) for r in _figures(each, "lang")}
    texts = {r.lang: r.c for r in seen.where(F.col("word") == END).select(F.explode("own").alias("o")).select("o.lang", "o.c").collect()}
    ends = sum(texts.values())
    names = sorted(langs)
    total, kinds = everywhere.n + ends, everywhere.kinds + (ends > 0)
    pieces = read_pieces(vocabulary)
    own_words = plain.select(F.explode("own.lang").alias("lang"), "word")
    sent = spark.sparkContext.broadcast((pieces, fitted_pieces(own_words, pieces, names, passes if names else 0)))
    known_langs = pa.array(names, pa.string())

    def spell(batches):
        held, weights = sent.value
        for table in _gathered(batches):
            word, c, own = table.column("word").to_pylist(), table.column("c").to_numpy(), _one(table.column("own"))
            new = np.flatnonzero(c == 0)
            every = _marginals(word, held, weights[-1:])[:, 0]
            every[[i for i, w in enumerate(word) if w == END]] = 0  # which no word reaches
            each = _marginals([word[i] for i in new.tolist()], held, weights[:-1])
            flat = own.flatten()
            bounds = pa.array(np.concatenate([[0], np.cumsum(pc.list_value_length(own).to_numpy())]), pa.int32())
            lang = pc.fill_null(pc.index_in(flat.field("lang"), value_set=known_langs), 0)  # the end may have further ones
            sizes = np.where(c == 0, each.shape[1], 0)
            yield from pa.table([
                table.column("word"), table.column("c"), pa.array(every, pa.float32()),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(each.ravel(), pa.float32())),
                pa.ListArray.from_arrays(bounds, lang), pa.ListArray.from_arrays(bounds, flat.field("c"))],
                names=["word", "c", "spelled", "each", "own_lang", "own_c"]).to_batches()

    scored = words.mapInArrow(
        spell, "word string, c bigint, spelled float, each array<float>, own_lang array<int>, own_c array<bigint>")
    looked_up = listed.select("block", "place", "word").join(kept(scored, "lattice-scored", compression="zstd"), "word").drop("word")

    # The last class is all languages together.
    figures = [langs[name] for name in names] + [everywhere]
    share = np.array([texts.get(name, 0) for name in names] + [1.0])
    share = np.log10(share / share.sum())
    new_mass = np.log10([f.new for f in figures])
    stop = (ends + 1) / (total + 2)
    classes = len(names)

    def score(key, left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        size = int(place.max(initial=-1)) + 1
        order = pa.array(np.argsort(place))
        right = right.take(order)
        c = right.column("c").to_numpy()
        spelled = right.column("spelled").to_numpy().astype(float)
        counts = _one(right.column("own_c"))
        own_size = pc.list_value_length(counts).to_numpy(zero_copy_only=False).astype(np.int64)
        own_c, own_lang = counts.flatten().to_numpy(), _one(right.column("own_lang")).flatten().to_numpy()
        owner = np.repeat(np.arange(size), own_size)
        # log10 P(word); the end of a text is counted apart.
        is_end = spelled == 0
        everyone = np.where(c > 0, np.log10(everywhere.known(c) + everywhere.new * 10.0 ** spelled + (c == 0)),
                            new_mass[-1] + spelled)
        # What a language gives to a word that it has no count of, but for its own spelling of new words.
        common = _mixed(everyone, spelled)
        common, everyone = np.where(is_end, 0, common), np.where(is_end, 0, everyone)
        # What languages add to that: by their counts, and by their spelling of new words.
        counted = np.zeros(len(own_c))
        for l, f in enumerate(figures[:-1]):
            mine = np.flatnonzero((own_lang == l) & ~is_end[owner])
            below = new_mass[l] + common[owner[mine]]
            counted[mine] = np.log10(f.known(own_c[mine]) + 10.0 ** below) - below
        new = np.repeat(np.flatnonzero(c == 0), classes)
        respelled = _mixed(everyone[new], _one(right.column("each")).flatten().to_numpy().astype(float)) - common[new]
        extra_at = np.concatenate([owner, new])
        sort = np.argsort(extra_at, kind="stable")
        extra_at = extra_at[sort]
        extra_class = np.concatenate([own_lang, np.tile(np.arange(classes), len(new) // max(classes, 1))])[sort]
        extra = np.concatenate([counted, respelled])[sort]
        extra_size = np.bincount(extra_at, minlength=size)
        extra_begin = np.cumsum(extra_size) - extra_size

        steps, times = _one(left.column("steps")), _one(left.column("times"))
        texts_here = left.num_rows
        doc_size = pc.list_value_length(steps).to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(texts_here), doc_size)
        running = np.cumsum(steps.flatten().to_numpy().astype(np.int64))
        before = np.concatenate([[0], running])[np.cumsum(doc_size) - doc_size]
        at = running - np.repeat(before, doc_size)
        often = times.flatten().to_numpy().astype(float)
        n = left.column("n").to_numpy()
        summed = lambda x: np.bincount(doc, often * x[at], minlength=texts_here)
        known = summed((c > 0).astype(float)).astype(np.int64)
        base = summed(np.log10((c + 1) / (total + kinds + 1)))
        reach = extra_size[at]
        entry = np.repeat(extra_begin[at], reach) + np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach)
        slot = np.repeat(doc, reach) * max(classes, 1) + extra_class[entry]
        gain = np.bincount(slot, np.repeat(often, reach) * extra[entry], minlength=texts_here * max(classes, 1))
        each_class = (gain.reshape(texts_here, -1)[:, :classes] + summed(common)[:, None] + share[:-1]
                      + (n - 1)[:, None] * new_mass[:-1])
        ways = np.concatenate([each_class, (summed(everyone) + share[-1])[:, None]], 1)
        most = ways.max(1)
        mixture = most + np.log10((10.0 ** (ways - most[:, None])).sum(1))
        scores = mixture + (n - 1) * np.log10(1 - stop) + np.log10(stop)
        return pa.table([left.column("doc_id"), left.column("train"), pa.array(n), pa.array(known),
                         pa.array(np.full(texts_here, total)), pa.array(base), pa.array(scores)],
                        names=["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    texts_rows = tokens.where("words is null").select(F.col("block").alias("home"), "doc_id", "train", "n", "steps", "times")
    return texts_rows.groupBy("home").cogroup(looked_up.groupBy("block")).applyInArrow(
        score, "doc_id bigint, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def _mixed(others: np.ndarray, own: np.ndarray) -> np.ndarray:
    """log10 of ``OTHER`` of the first and the rest of the second, both log10."""
    return np.logaddexp(others * np.log(10) + np.log(OTHER), own * np.log(10) + np.log1p(-OTHER)) / np.log(10)


def _one(column: pa.ChunkedArray) -> pa.Array:
    array = column.combine_chunks()
    return array.chunk(0) if isinstance(array, pa.ChunkedArray) else array


def score_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Scores of all documents, learnt from those whose crc32 of the id, mod 7, is not 2."""
    held_out = F.pmod(crc_of_id(), F.lit(7)) == 2
    return score_texts(docs, vocabulary, ~held_out).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


ship(__name__)
