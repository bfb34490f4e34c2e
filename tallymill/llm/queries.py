"""The operators' queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chunking import repeated_spans
from .conversations import repaired_conversations
from .decontamination import ORACLE as DECONTAMINATION
from .decontamination import contaminated
from .jaccard import jaccard_classes
from .language import predicted_languages
from .licenses import license_scan
from .lm import scored_corpus
from .negatives import ORACLE as NEGATIVES
from .negatives import mined_negatives
from .neighbours import near_vectors
from .packing import pack_documents
from .secrets import secret_digests
from .spread import ship, table
from .suffixes import suffix_dedup
from .warc import warc_round_trip

Query = Callable[[SparkSession, str], DataFrame]


def _over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return operator(table(spark, sf_dir, name))

    return query


def _contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)


QUERIES: dict[str, Query] = {
    "op1_near_vectors": _over("embeddings", near_vectors),
    "op2_jaccard_join": _over("documents", jaccard_classes),
    "op3_warc_round_trip": _over("pages", warc_round_trip),
    "op4_license_scan": _over("documents", license_scan),
    "op5_substring_dedup": _over("documents", repeated_spans),
    "op6_lm_scoring": _over("documents", scored_corpus),
    "op7_decontamination": _contaminated,
    "op8_secret_scan": _over("documents", secret_digests),
    "op9_packing": _over("documents", pack_documents),
    "op10_language_id": _over("documents", predicted_languages),
    "op11_hard_negatives": _over("embeddings", mined_negatives),
    "op12_conversation_repair": _over("conversations", repaired_conversations),
    "op13_suffix_dedup": _over("documents", suffix_dedup),
}

ORACLES: dict[str, str] = {
    "op7_decontamination": DECONTAMINATION,
    "op11_hard_negatives": NEGATIVES,
    "op3_warc_round_trip": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html,
                   octet_length(encode(coalesce(html, ''))) AS bytes
            FROM pages
        ), k AS (
            SELECT *, sha1(html) AS digest, max(page_id) OVER (PARTITION BY html) AS keeper FROM p
        )
        SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN bytes >= 1000 AND page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN bytes >= 1000 AND page_id < keeper THEN keeper END AS refers_to
        FROM k
    """,
}
