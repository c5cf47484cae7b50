"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import decontamination as DC
from candlewick.llm import embedding_dedup as ED
from candlewick.llm import hmm_scoring as HM
from candlewick.llm import importance_resampling as IR
from candlewick.llm import language_id as LI
from candlewick.llm import line_dedup as LD
from candlewick.llm import minhash_dedup as MH
from candlewick.llm import packing as PK
from candlewick.llm import pii as PI
from candlewick.llm import spelling_variants as SV
from candlewick.llm import sql as S
from candlewick.llm import substring_dedup as SD
from candlewick.llm import token_files as TF
from candlewick.llm import warc as WA
from candlewick.llm.common import prepare, table

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        SPARK[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return add


@register("op3_line_dedup", S.OP3)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = LD.kept_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def tokenizer(name: str) -> str:
    """The place of a public tokenizer file; the package is on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = TF.write_ids(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=0)
    return TF.read_ids(manifest)


@register("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PK.pack_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=2)


@register("op10_warc", S.OP10)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archive = WA.write_archive(pages, min_bytes=0)
    return WA.read_records(WA.find_captures(archive, pages)).drop("url")


@register("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return LI.identify(docs, LI.fit(docs))


@register("op2_minhash_dedup", S.OP2)
def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MH.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@register("op5_decontamination")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DC.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op7_embedding_dedup", S.OP7)
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ED.near_embeddings(table(spark, sf_dir, "embeddings"))


@register("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PI.pii_report(table(spark, sf_dir, "documents"))


@register("op4_substring_dedup")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SD.repeated_passages(table(spark, sf_dir, "documents"))


@register("op11_spelling_variants", S.OP11)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SV.spelling_variants(table(spark, sf_dir, "documents"))


@register("op12_importance_resampling", S.OP12)
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = IR.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


@register("op13_hmm_scoring")
def op13_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7))
    rows = HM.hmm_scores(table(spark, sf_dir, "documents"), remainder != 2)
    return rows.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
