"""The registered queries of this folder, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from duebook.llm import (
    chat_format,
    collocations,
    decontaminate,
    html_text,
    language_id,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    periodic_runs,
    quality_rules,
    token_codes,
    toxicity,
)
from duebook.llm.shared import ship

MODULES = {
    "op1_language_id": language_id,
    "op2_html_text": html_text,
    "op3_line_dedup": line_dedup,
    "op4_chat_format": chat_format,
    "op5_decontamination": decontaminate,
    "op6_packing": packing,
    "op7_quality_rules": quality_rules,
    "op8_token_codes": token_codes,
    "op9_ngram_join": ngram_join,
    "op10_license_scan": license_scan,
    "op11_toxicity": toxicity,
    "op12_periodic_runs": periodic_runs,
    "op13_collocations": collocations,
}


def with_package(query: Callable) -> Callable:
    """``query`` after the executors have this package."""

    @wraps(query)
    def run(spark: SparkSession, *rest) -> DataFrame:
        ship(spark)
        return query(spark, *rest)

    return run


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: with_package(module.query) for name, module in MODULES.items()}
    found["language_of_pages"] = with_package(language_id.query_pages)
    found["chat_attachments"] = with_package(chat_format.query_attachments)
    return found


def all_statements() -> dict[str, str]:
    found = {name: module.SQL for name, module in MODULES.items() if module.SQL}
    return found | {"chat_attachments": chat_format.ATTACHMENTS_SQL}
