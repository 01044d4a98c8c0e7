"""The operators' queries over the given tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (ann, collocations, decontaminate, jaccard, language, lattice, packing, quality, secret_scan, tokens,
                          toxicity, warc, whitening)
from tidemark.llm.common import table
from tidemark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op2_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of document and benchmark item that occurs in it, with the edits and the region."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", F.explode(decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))).alias("m"))
    return found.select("doc_id", "m.item_id", "m.edits", "m.begin", "m.end")


@query
def op4_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return jaccard.join_documents(table(spark, sf_dir, "documents"))


def packing_length():
    """Units of a text for a model on bytes: its UTF-8 and one end mark."""
    return F.coalesce(F.octet_length("text"), F.lit(0)) + 1


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written and read back; digests come from the files."""
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return tokens.token_digests(spark, path)


@query
def op1_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op5_variable_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, measured in bytes of UTF-8 and an end mark, packed into sequences."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing_length())


@query
def op6_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base patterns, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = secret_scan.found_spans(docs, keep=["doc_id"])
    base = F.filter("spans", lambda x: x.k < 3)
    count = lambda kind: F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", count("assign"), count("access"), count("hex"),
                       F.sha2(secret_scan.span_text(base).cast("binary"), 256).alias("base_sha256"),
                       secret_scan.span_text("spans").alias("spans"))


@query
def op9_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written and read back."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, payloads=False).drop("payload").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0").select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query
def op11_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of every document under the lattice of pieces and words."""
    return lattice.score_documents(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query
def op12_jacobi_davidson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four leading components of every vector, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_stripe_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op13_stripe_collocations"] = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, i, unnest([1, 2, 3, 4, 5]) AS k FROM starts) WHERE i + k - 1 <= len(w)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
often AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f FROM counts WHERE f >= 100),
inner_phrases AS (SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, array_to_string(w[1:k - 1], ' ') AS phrase, f FROM often WHERE k > 2
    UNION ALL SELECT lang, array_to_string(w[2:k], ' '), f FROM often WHERE k > 2) GROUP BY ALL),
free AS (SELECT o.lang, o.phrase, o.w, o.k, o.f FROM often o LEFT JOIN inner_phrases i USING (lang, phrase)
  WHERE o.k > 1 AND o.f > coalesce(i.f, 0)),
cuts AS (SELECT lang, phrase, w, k, f, unnest(range(1, k)) AS cut FROM free),
scores AS (SELECT c.lang, c.phrase, c.f AS a, c.cut, x.f AS l, y.f AS r, t.n,
    (1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')
  JOIN totals t ON t.lang = c.lang),
least AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000"""
