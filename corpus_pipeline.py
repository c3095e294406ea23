"""From raw documents to token ids: the stages of a training corpus, each an operator of ``clicksieve.llm``.

Each stage takes the documents its predecessor kept, written as Parquet and
read again, so a stage that is lost starts from files.
"""

import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clicksieve.llm import byte_bpe, language_id, mixing, personal_data, shingle_join  # noqa: E402
from clicksieve.llm.common import saved, table  # noqa: E402
from clicksieve.llm.vocabularies import BYTE_VOCABULARY, split_pattern, vocabulary  # noqa: E402
from clicksieve.session import use_short_batches  # noqa: E402

# With four languages chance is 0.25; a clean text is hardly ever below one half.
LEAST_SCORE = 0.4


def known_language(spark, docs, sf_dir):
    """Documents whose language the network tells; texts without letters and unclear ones go."""
    use_short_batches(spark)
    return language_id.filter_language(docs, least=LEAST_SCORE)


def one_of_each_group(spark, docs, sf_dir):
    """Of each group of near duplicates the document with the smallest id."""
    use_short_batches(spark)
    return shingle_join.without_near_duplicates(docs)


def masked(spark, docs, sf_dir):
    """All documents, with personal data in their texts replaced by its kind."""
    return personal_data.mask_personal_data(docs)


def mixed(spark, docs, sf_dir):
    """Sources at their target weights: documents are taken once, twice or not at all."""
    return mixing.mixed_documents(docs)


def encoded(spark, docs, sf_dir):
    """``doc_id, lang, source, n_tokens, ids`` of each document."""
    use_short_batches(spark)
    rows = byte_bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"), vocabulary(BYTE_VOCABULARY), split_pattern())
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("PII", masked),
    ("mixing", mixed),
    ("byte-level BPE", encoded),
]

# A trained network decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The documents through all stages."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = saved(docs, f"pipeline-{number}")
    return docs
