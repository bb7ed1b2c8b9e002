"""Queries of this subpackage: one per operator, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from castledger.llm.bpe import op10_byte_bpe
from castledger.llm.compact_windows import op8_substring_dedup
from castledger.llm.cotraining import op9_quality_classifier
from castledger.llm.decontaminate import OP6_SQL, op6_decontaminate
from castledger.llm.jaccard_join import OP12_SQL, op12_jaccard_join
from castledger.llm.language_id import op5_language_id
from castledger.llm.lexical_search import OP11_SQL, op11_lexical_search
from castledger.llm.licenses import op4_license_scan
from castledger.llm.minhash import OP3_SQL, op3_near_duplicates
from castledger.llm.quality_rules import OP2_SQL, op2_quality_rules
from castledger.llm.suffix_dedup import op1_suffix_dedup
from castledger.llm.tokencounts import op7_token_counts
from castledger.llm.whitening import op13_embedding_whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_quality_rules, op3_near_duplicates, op4_license_scan,
                                    op5_language_id, op6_decontaminate, op7_token_counts, op8_substring_dedup, op9_quality_classifier,
                                    op10_byte_bpe, op11_lexical_search, op12_jaccard_join, op13_embedding_whitening)}


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": OP2_SQL, "op3_near_duplicates": OP3_SQL,
            "op6_decontaminate": OP6_SQL, "op11_lexical_search": OP11_SQL, "op12_jaccard_join": OP12_SQL}
