"""Five stages from raw documents to a clean, deduplicated, encoded corpus.

Each stage reads all that the one before it kept, as Parquet, and all but the
last return the columns of documents:

- quality rules reject documents that fail the base rules or are depleted once
  their host's common lines are removed, and take these lines out of the others;
- the n-gram join keeps one document of each group of near copies (five-word
  shingles, linked from a Jaccard similarity of 0.8 up), the one with the
  smallest id (documents without words link with nothing and all stay);
- decontamination drops documents that share a passage with the benchmark;
- the secret scan keeps every document and masks secrets in its text;
- the last stage encodes and decodes the texts and adds the digests.

Results by case: documents with a null or empty text fail the base rules and go;
rows without an id have no smaller id to lose to and stay; rows that repeat an
id go or stay together; an empty table gives an empty result; columns other than
those of documents are not carried along, so their names never clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadglass.llm import bpe, decontaminate, jaccard_join, quality, secrets
from roadglass.llm.common import Workspace, scratch, table
from roadglass.llm.queries import BPE_VOCABULARY

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Pre-tokens that a worker remembers; fewer than by itself, since workers serve all stages.
REMEMBERED = 120_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.representatives(docs.select(*COLUMNS), percent=80, words=5).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def secret_masks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("long"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs.select(*COLUMNS), BPE_VOCABULARY, extra=COLUMNS[1:], remembered=REMEMBERED).select(*COLUMNS, "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_masks),
    ("byte-level BPE", encoding),
]

#: The joins by set similarity and the codec have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark)
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    before = None
    for name, stage in STAGES:
        with scratch():
            docs = work.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            work.drop(before)
        before = docs
    return docs
