"""The operators as queries over the given tables, and SQL to check them with."""

import corpus_pipeline
from pyspark.sql import functions as F

from clicksieve.llm import (
    byte_bpe,
    fill_middle,
    language_id,
    mixing,
    packed_ids,
    personal_data,
    quality,
    quality_classifier,
    secret_scan,
    shingle_join,
    substring_dedup,
    vantage_trees,
    vector_codes,
)
from clicksieve.llm.common import table
from clicksieve.llm.vocabularies import BYTE_VOCABULARY, END_ID, WORD_VOCABULARY, split_pattern, vocabulary

def op1_quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


def op2_packed_ids(spark, sf_dir):
    return packed_ids.packed_round_trip(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY), END_ID)


def op3_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op4_shingle_join(spark, sf_dir):
    return shingle_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_personal_data(spark, sf_dir):
    return personal_data.find_personal_data(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY), split_pattern())


def op7_mixing(spark, sf_dir):
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_secrets(spark, sf_dir):
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op9_vantage_trees(spark, sf_dir):
    # Factor one: the whole of the exact answer, which SQL can check.
    return vantage_trees.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, factor=1.0)


def op10_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark, sf_dir):
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_fill_middle(spark, sf_dir):
    return fill_middle.digests(table(spark, sf_dir, "documents"))


def op13_quality_classifier(spark, sf_dir):
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_packed_ids": op2_packed_ids,
    "op3_language_id": op3_language_id,
    "op4_shingle_join": op4_shingle_join,
    "op5_personal_data": op5_personal_data,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_mixing": op7_mixing,
    "op8_secrets": op8_secrets,
    "op9_vantage_trees": op9_vantage_trees,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_fill_middle": op12_fill_middle,
    "op13_quality_classifier": op13_quality_classifier,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op4_shingle_join": shingle_join.ORACLE,
    "op9_vantage_trees": vantage_trees.ORACLE,
    "op1_quality_rules": quality.oracle(),
    "op10_substring_dedup": substring_dedup.ORACLE,
    "op11_vector_codes": vector_codes.oracle(),
    "op12_fill_middle": fill_middle.ORACLE,
}

if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
