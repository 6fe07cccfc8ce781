"""The registered queries of the text operators and their SQL, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetpulse.llm import (
    anchors,
    brown,
    chat,
    clustering,
    decontaminate,
    exact_dedup,
    packing,
    phrases,
    pii,
    quality,
    repeats,
    simhash,
    token_lengths,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_suffix_array_dedup": repeats.op2_suffix_array_dedup,
    "op3_quality": quality.op3_quality,
    "op4_packing": packing.op4_packing,
    "op5_token_lengths": token_lengths.op5_token_lengths,
    "op6_pii": pii.op6_pii,
    "op7_decontamination": decontaminate.op7_decontamination,
    "op8_simhash": simhash.op8_simhash,
    "op9_brown_scores": brown.op9_brown_scores,
    "op10_substring_dedup": anchors.op10_substring_dedup,
    "op11_centroid_clustering": clustering.op11_centroid_clustering,
    "op12_chat_formatting": chat.op12_chat_formatting,
    "op13_collocations": phrases.op13_collocations,
}

SQL: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op7_decontamination": decontaminate.SQL,
    "op11_centroid_clustering": clustering.SQL,
    "op12_chat_formatting": chat.SQL,
    "op13_collocations": phrases.SQL,
}
