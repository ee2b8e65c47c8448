"""The operators applied to whole tables, registered as ``op<N>_<name>``, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import bpe, codes, linededup, lm, neighbours, packing, parity, quality, rules, tokenfile, toxicity, whitening, wrappers
from shelfcast.llm.columns import fold, texts_only

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function=None, *, oracle: str | None = None):
    """Register a function under its own name, with SQL for the same rows if there is any."""
    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register if function is None else register(function)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all documents, learned from those outside the seventh held out."""
    docs = texts_only(table(spark, sf_dir, "documents"))
    scored = lm.score(docs, lm.fit(docs, fold("doc_id", 7) != 2), keep=["doc_id"])
    return scored.select(
        "doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from labels outside the fifth that is held out."""
    docs = texts_only(table(spark, sf_dir, "documents"))
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", fold("doc_id", 5) != 0)
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of every fiftieth."""
    found = neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op5_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all documents the lines that repeat another line, exactly or nearly."""
    return linededup.report(table(spark, sf_dir, "documents"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels outside the third that is held out."""
    docs = texts_only(table(spark, sf_dir, "documents"))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", fold("doc_id", 3) != 1)
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted", F.size("spans").cast("bigint").alias("n_spans"))


@query
def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page, by the wrapper of its host."""
    return wrappers.main_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


@query
def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents and the verdict of the learned decision list."""
    docs = texts_only(table(spark, sf_dir, "documents"))
    judged = rules.judge(docs, rules.fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("verdict")).alias("kept"))


JACCARD_SQL = """with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
 shingles as materialized (select distinct doc_id, unnest(case when len(w) >= 3 then list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])
  when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from words),
 sizes as materialized (select doc_id, count(*) as n from shingles group by 1),
 common as (select a.doc_id as a, b.doc_id as b, count(*) as i from shingles a join shingles b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
 links as materialized (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * i >= 90 * (x.n + y.n - i)),
 reach as (select doc_id as a, doc_id as c from documents union select reach.a, links.b from reach join links on reach.c = links.a)
 select d.doc_id, coalesce(any_value(n), 0) as n_shingles, min(c) as component_id from documents d join reach on reach.a = d.doc_id left join sizes s on s.doc_id = d.doc_id group by 1"""


@query(oracle=JACCARD_SQL)
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are similar by 0.9 or more."""
    return parity.similar(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, and what they decode to, as digests."""
    docs = texts_only(table(spark, sf_dir, "documents"))
    coded = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query
def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, how far they are from what the codes stand for, and the codebooks' digest."""
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return codes.with_group_error(coded).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(codes.digest(books)).alias("codebooks_sha256"))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on the sixteen leading components, with unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), "component", "n", "deviation", "whitened", "explained", "identity_error", "residual", "passes")


@query
def op13_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as their token files hold them."""
    folder = tokenfile.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return tokenfile.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
