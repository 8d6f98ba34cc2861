"""Corpus pipeline: toxic documents go, then lines that other documents hold, then near
duplicates but one, then documents that hold benchmark items; what stays is encoded.

Each stage is (name, function); a function takes (spark, docs, sf_dir), works on all that the
stage before kept, and returns a DataFrame: the columns of ``documents``, but for the last.
Every case that the operators define holds here: null and empty texts stay (they are clean),
rows without an id stay, repeated rows are one document, and extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealflow.llm.bpe import encode
from dealflow.llm.common import cut, table
from dealflow.llm.decontaminate import find_leaks
from dealflow.llm.line_dedup import dedup_lines
from dealflow.llm.near_dup import near_duplicates
from dealflow.llm.queries import sha, vocabulary
from dealflow.llm.toxicity import fit, score_toxicity

TOXIC = 0.7


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under TOXIC. The model is learned from ``docs`` and the
    labels that may be learned from."""
    scorer = fit(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, scorer, prefix="__toxicity_").where(F.col("__toxicity_score") < TOXIC).select(*[F.col(f"`{c}`") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document with a smaller id holds too; ``n_chars`` is counted anew."""
    own = [f"__{i}" for i in range(len(docs.columns))]
    packed = docs.toDF(*own)
    at = {c: own[i] for i, c in enumerate(docs.columns)}
    got = dedup_lines(packed, text=at["text"], doc_id=at["doc_id"], carry=own)
    out = {c: F.col(at[c]) for c in docs.columns} | {"text": F.when(F.col(at["text"]).isNotNull(), F.col("kept"))}
    if "n_chars" in out:
        out["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("kept")).otherwise(F.col(at["n_chars"])).cast(docs.schema["n_chars"].dataType)
    return got.select(*[v.alias(c) for c, v in out.items()])


def near_duplicate_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, the document with the smallest id; of rows that repeat its
    id and text, one."""
    found = cut(near_duplicates(docs), "near-duplicates")
    rows = found.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.count("*").alias("rows"))
    change = cut(rows.where("doc_id is not null and (class_id <> doc_id or rows > 1)").select("doc_id", (F.col("class_id") != F.col("doc_id")).alias("goes")), "dropped-documents")
    once = docs.join(change, "doc_id", "left_anti")
    repeated = docs.join(change.where("not goes"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeated)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    got = find_leaks(docs, table(spark, sf_dir, "benchmark"), out="__leaks")
    return got.where(F.size("__leaks") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, and decoded again."""
    got = encode(docs, vocabulary(), keep=["doc_id"], decoded="decoded")
    return got.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                      F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), ","), "UTF-8"), 256).alias("ids_sha256"), sha("decoded").alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicate_join), ("benchmark decontamination", decontaminate), ("BPE encoding and decoding", bpe)]

#: SQL can express neither the models nor the encoding; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole of ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
