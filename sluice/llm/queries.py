"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from sluice.llm import toxicity
from sluice.llm.cotraining import classify
from sluice.llm.debruijn import dedup_substrings
from sluice.llm.decontaminate import contamination
from sluice.llm.divergence import AUDIT_SQL, audit_sources
from sluice.llm.licences import scan_licences, scan_sql
from sluice.llm.minhash import near_duplicates
from sluice.llm.packing import pack, token_pieces
from sluice.llm.pivot_codes import compress, with_label_errors
from sluice.llm.registry import query, table
from sluice.llm.repetition import repetition_rules
from sluice.llm.suffix_dedup import dedup_bytes
from sluice.llm.token_blocks import read_documents, write_token_blocks
from sluice.llm.tokens import vocabulary_path
from sluice.llm.url_rules import judge_urls
from sluice.session import shared_folder

VOCABULARY = "byte_bpe_50k.json"


# The rules of the URL query.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@query("op1_redirect_equivalence")
def op1(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "rule STRING, action STRING")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


@query("op3_suffix_repetition")
def op3(spark, sf_dir):
    return repetition_rules(table(spark, sf_dir, "documents"))


@query("op4_licence_sentences", scan_sql())
def op4(spark, sf_dir):
    found = scan_licences(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))


@query("op5_min_bin_slack")
def op5(spark, sf_dir):
    return pack(token_pieces(table(spark, sf_dir, "documents"), vocabulary_path(VOCABULARY)))


@query("op6_bit_packed_tokens")
def op6(spark, sf_dir):
    folder = shared_folder(spark, "token-blocks")
    write_token_blocks(table(spark, sf_dir, "documents"), folder, vocabulary_path(VOCABULARY))
    return read_documents(spark, folder)


@query("op8_winnowing")
def op8(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated"
    )


@query("op10_cotraining")
def op10(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_debruijn_compaction")
def op7(spark, sf_dir):
    found = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    # Words as the contract joins them, also in texts that lost none.
    kept = F.concat_ws(" ", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


@query("op9_blockwise_suffixes")
def op9(spark, sf_dir):
    found = dedup_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_one_permutation")
def op2(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


@query("op12_source_divergence", AUDIT_SQL)
def op12(spark, sf_dir):
    return audit_sources(table(spark, sf_dir, "documents"))


@query("op13_laesa_pivots")
def op13(spark, sf_dir):
    codes, trained = compress(table(spark, sf_dir, "embeddings"))
    digest = trained.digest() if trained else hashlib.sha256(b"").hexdigest()
    return with_label_errors(codes).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


@query("op11_nearest_examples")
def op11(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
