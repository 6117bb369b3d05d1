"""From raw documents to tokens, in five stages; each works on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm import bpe, decontaminate, linededup, minhash, toxicity
from rillstone.llm.shared import table
from rillstone.sources.documents import remove
from rillstone.workspace import new_folder

#: The columns of documents, which all stages but the last return.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half.

    The model is that of the operator's query: it learns from a bounded sample of the
    labelled rows of the given tables. Null and empty texts are scored like all others,
    repeated rows alike, texts of any length whole.
    """
    model = toxicity.model_of(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(COLUMNS), model, keep=tuple(COLUMNS))
    return scored.where("score < 0.5").select(COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of lines that stand elsewhere first.

    A document of which more than four fifths stand in documents before it is a copy but for a
    few lines, and is dropped; what is left of it would be no near duplicate of anything. Null and empty documents stay, repeated rows stay or go together, texts of any
    length are taken whole.
    """
    return linededup.cleaned_documents(docs.select(COLUMNS), most_copied=0.8)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Groups are linked at a Jaccard index of 0.8 of five-word shingles. Of rows that share an
    id and a text one stays.
    """
    groups = minhash.near_duplicates(docs, percent=80).where("kept and doc_id is not null")
    kept = groups.select("doc_id").distinct()
    # rows without an id belong to no group
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    unnamed = docs.where("doc_id is null")
    return named.dropDuplicates(["doc_id", "text"]).unionByName(unnamed).select(COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item.

    Null and empty texts hold none; repeated rows stay or go together, texts of any
    length are taken whole.
    """
    found = decontaminate.find(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"), tuple(COLUMNS))
    return found.where(F.size("matches") == 0).select(COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them.

    Null and empty texts have no tokens; repeated rows are repeated, long texts taken whole.
    """
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.digests(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("bpe", tokenize),
]

#: Learned scores and token ranks cannot be expressed in SQL; tests hold the stages
#: against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written as Parquet and read again.

    What a stage has read is removed once its own result is written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
