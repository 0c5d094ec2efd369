"""From documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
`docs`. `run` writes each stage's result to the shared folder and reads it back for the next, so a lost executor repeats
at most one stage.

1. quality_rules: failing lines are removed; documents that fail the rules or lose too much are dropped.
2. near_dedup: of each group of near-copies (80 % or more of their runs of five words shared) the document with the
   smallest id stays. Each row is a document of its own: rows that repeat an id are judged by their texts, and of
   copies under one id, or without any, one stays. NULL ids come last. Texts without words stay.
3. substring_dedup: runs of 50 words that start in an earlier document are cut out. Documents stay, if only as ''.
4. mixing: documents are sampled to tempered shares of source, language and form; empty documents are never drawn.
5. packing: the sample becomes pieces placed in sequences of at most 2048 tokens.

`n_chars`, where there is one, follows the text. Columns other than doc_id, text, source and lang pass through.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import common
from ledgermill.llm.line_rules import line_quality
from ledgermill.llm.mixing import mix_documents
from ledgermill.llm.near_copies import near_copies
from ledgermill.llm.packing import pack
from ledgermill.llm.substrings import cut_repeats

#: Texts with this share of their joint runs of five words or more are near-copies; op8 asks for 85.
SIMILAR_PERCENT = 80


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with neutral column names, which no operator adds, and the names by the original ones."""
    names = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _with_text(out: DataFrame, text: str, docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of docs from `out`, with the text (and its length) taken from column `text`."""
    columns = {names["text"]: F.col(text)}
    if "n_chars" in names:
        columns[names["n_chars"]] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return out.withColumns(columns).select(*names.values()).toDF(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain, names = _plain(docs)
    others = [c for name, c in names.items() if name != "text"]
    judged = line_quality(plain, text=names["text"], carry=others, with_text=True)
    return _with_text(judged.where("kept"), "clean_text", docs, names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain, names = _plain(docs)
    numbered = common.saved(plain.withColumn("row", F.monotonically_increasing_id()), "numbered")
    judged = near_copies(numbered.select("row", names["text"]), "row", names["text"], percent=SIMILAR_PERCENT)
    members = judged.select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    members = common.saved(members.join(numbered.select("row", F.col(names["doc_id"]).alias("id")), "row"), "members")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))
    stays = common.saved(members.groupBy("group").agg(first.alias("first")).select("group", "first.row"), "stays")
    goes = members.join(stays.withColumnRenamed("row", "stays"), "group").where("row != stays").select("row")
    return numbered.join(common.saved(goes, "goes"), "row", "left_anti").select(*names.values()).toDF(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain, names = _plain(docs)
    others = [c for name, c in names.items() if name not in ("doc_id", "text")]
    cut = cut_repeats(plain, id_column=names["doc_id"], text=names["text"], carry=others, with_text=True)
    return _with_text(cut, "kept_text", docs, names)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain, names = _plain(docs)
    mixed = mix_documents(plain, names["doc_id"], names["text"], names["source"], names["lang"])
    return mixed.where("sampled").select(*names.values()).toDF(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Signatures, tokens and hashes of passages can't be expressed in SQL; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.saved(stage(spark, docs, sf_dir), name)
    return docs
