"""Queries of the text operators by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scoremill.llm import host_rules, licenses
from scoremill.llm.bpe_codec import op11_bpe_codec
from scoremill.llm.chat_format import op8_chat_format
from scoremill.llm.conversation_repair import op13_conversation_repair
from scoremill.llm.decontamination import op3_decontamination
from scoremill.llm.host_rules import op7_host_rules
from scoremill.llm.language_id import op4_language_id
from scoremill.llm.licenses import op5_license_scan
from scoremill.llm.near_duplicates import op10_near_duplicates
from scoremill.llm.pitman_yor import op6_pitman_yor
from scoremill.llm.quality_classifier import op1_quality_classifier
from scoremill.llm.sentencepiece_codec import op2_sentencepiece
from scoremill.llm.spelling_variants import op12_spelling_variants
from scoremill.llm.token_files import op9_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_decontamination": op3_decontamination,
    "op4_language_id": op4_language_id,
    "op5_license_scan": op5_license_scan,
    "op6_pitman_yor": op6_pitman_yor,
    "op7_host_rules": op7_host_rules,
    "op8_chat_format": op8_chat_format,
    "op9_token_files": op9_token_files,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_bpe_codec": op11_bpe_codec,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE: dict[str, str] = {
    "op5_license_scan": licenses.SQL,
    "op7_host_rules": host_rules.SQL,
}
