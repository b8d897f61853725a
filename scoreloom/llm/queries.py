"""The operators over the given tables, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scoreloom.llm import byte_pairs
from scoreloom.llm.language_id import identified, learn
from scoreloom.llm.licences import document_licences
from scoreloom.llm.line_dedup import without_repeats
from scoreloom.llm.mixing import mixed_copies
from scoreloom.llm.ngram_join import similar_components
from scoreloom.llm.period_runs import periodic_runs
from scoreloom.llm.pii import pseudonymised
from scoreloom.llm.piece_tokens import encoded
from scoreloom.llm.quality import quality_verdicts
from scoreloom.llm.spelling import spelling_variants, without_a_letter, word_counts
from scoreloom.llm.text_sql import let, words
from scoreloom.llm.topk_search import top_k
from scoreloom.llm.warc_archive import archive, read_archive, rebuilt_digests
from scoreloom.plans.staging import new_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


HELD_OUT = "coalesce(crc32(CAST(doc_id AS string)) % 3 = 1, false)"
SURROGATE_KEY = b"a key of the deployment"  # whoever runs this for real passes their own
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = identified(docs, learn(docs.where(f"NOT {HELD_OUT}")))
    return found.selectExpr("doc_id", f"{HELD_OUT} AS held_out", "lang_pred", "score")


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(_table(spark, folder, "documents")).select("doc_id", "text", "n_removed")


def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_components(_table(spark, folder, "documents"), k=4, percent=85)


def op4_licences(spark: SparkSession, folder: str) -> DataFrame:
    return document_licences(_table(spark, folder, "documents"))


def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return encoded(docs, PIECES, decoded="decoded").selectExpr(
        "doc_id", "bigint(size(ids)) AS n_tokens", "ids", "decoded <=> text AS lossless"
    )


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonymised(_table(spark, folder, "documents").select("doc_id", "text"), SURROGATE_KEY)


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixed_copies(_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_verdicts(_table(spark, folder, "documents"))


def op9_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(_table(spark, folder, "embeddings"), "vec_id % 20 = 0")


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "warc")
    archive(_table(spark, folder, "pages"), path)
    return rebuilt_digests(read_archive(spark, path)).drop("header_digest")


def op11_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = _table(spark, folder, "documents").selectExpr("doc_id", "coalesce(text, '') AS text")
    return byte_pairs.encoded(docs, ranks, public_tokenizers.PATTERN, packed=True, decoded="decoded", keep=["doc_id"]).selectExpr(
        "doc_id", "bigint(length(ids) div 4) AS n_tokens", "sha2(ids, 256) AS ids_sha256", "sha2(decoded, 256) AS decoded_sha256"
    )


def with_planted_period(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: where h = crc32(doc_id) ends in 0, the words from a on repeat with period p."""
    h, g = "crc32(CAST(doc_id AS string))", "(crc32(CAST(doc_id AS string)) div 10)"
    turned = "transform(w, (x, i) -> IF(i < s.a, x, w[int(s.a + (i - s.a) % s.p)]))"
    placed = let(f"named_struct('a', {g} % size(w), 'p', 1 + (size(w) - {g} % size(w)) div (3 + {g} % 8))", "s", turned)
    planted = let(words("text"), "w", f"IF(size(w) = 0, '', array_join({placed}, ' '))")
    return docs.selectExpr("doc_id", f"CASE WHEN {h} % 10 = 0 THEN {planted} ELSE text END AS text")


def op12_period_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(with_planted_period(_table(spark, folder, "documents")))
    better = "x.length * b.period > b.length * x.period"  # runs come by start, then period
    told = found.selectExpr(
        "doc_id",
        "bigint(size(runs)) AS n_runs",
        f"aggregate(runs, get(runs, 0), (b, x) -> IF({better}, x, b)) AS best",
        "sha2(concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n'))), 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )
    return told.selectExpr(
        "doc_id", "n_runs", "best.start AS start", "best.length AS length", "best.period AS period",
        "1000 * best.length div best.period AS exponent_milli", "runs_sha256", "collapsed_sha256",
    )


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(word_counts(_table(spark, folder, "documents"), change=without_a_letter))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_line_dedup": op2_line_dedup,
    "op3_ngram_join": op3_ngram_join,
    "op4_licences": op4_licences,
    "op5_pieces": op5_pieces,
    "op6_pii": op6_pii,
    "op7_mixing": op7_mixing,
    "op8_quality": op8_quality,
    "op9_topk": op9_topk,
    "op10_warc": op10_warc,
    "op11_byte_pairs": op11_byte_pairs,
    "op12_period_runs": op12_period_runs,
    "op13_spelling": op13_spelling,
}
