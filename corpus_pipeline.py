"""The corpus pipeline: toxicity, SimHash near-dedup, suffix-array dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areapanel.llm import simhash, toxicity
from areapanel.llm.common import save, table
from areapanel.llm.packing import pack
from areapanel.llm.suffix_dedup import without_repeats

THRESHOLD = 0.7
#: Passages of over 50 words.
PASSAGE_WORDS = 51
#: Fingerprints of five-word shingles in 512 bits, of which a sixth or fewer differ (78 do, give or take 8, where texts
#: share 0.8 of their shingles; 98 where they share 0.7, 118 where 0.6).
#: Links are then confirmed by counting shingles.
NEAR = {"words": 5, "bits": 512, "radius": 22, "total_radius": 88, "least": 0.8, "band": 16}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled rows that are not held out; documents scored at the threshold or more go.

    Null and empty texts have nothing to reject and stay; rows are judged one by
    one, so ties, repeated rows and rows with a null id stay or go on their own.
    Columns keep their values whatever their names.  An empty table stays empty.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    numbered = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))  # no column can clash with those of the scores
    scored = toxicity.score(numbered, model, text_col=f"c{docs.columns.index('text')}", threshold=THRESHOLD)
    return scored.where("predicted = 0").select(*numbered.columns).toDF(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 0.8 or more of their five-word shingles, directly or through others, the one with the least id stays.

    Fingerprints find the pairs, counts of shingles confirm them.

    Of rows that share that id one stays.  Rows with a null id can't be compared and go.
    Null and empty texts have fingerprint zero and are copies of each other.  Very long
    texts are taken whole.  An empty table stays empty.
    """
    kept = save(simhash.near_duplicates(docs, **NEAR).where("kept").groupBy("doc_id").count(), "pipeline-kept")
    once = docs.join(kept.where("count = 1"), "doc_id", "left_semi")
    more = docs.join(kept.where("count > 1"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return once.unionByName(more).select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of over 50 words that occur again, wherever they do; ``n_chars`` follows the text.

    Words are counted because 400 bytes, op4's measure, are about 65 words of
    prose: shorter passages would stay.  Documents that lose all their text
    stay as empty ones; null texts stay null; rows with a null id go.
    """
    left = without_repeats(docs, length=PASSAGE_WORDS, unit="words")
    if "n_chars" in left.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast(left.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2,048 ids, by piece; null and empty texts are their end id alone."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("suffix_dedup", cut_repeats),
    ("packing", pack_windows),
]

#: SQL has neither the learned scores, nor XXH64, nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
