"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnwheel.llm import decontaminate, filteraudit, htmltext, jaccard, licenses, linededup, mixing, quality, records, spelling, suffixdedup, suffixtree, unigram
from tarnwheel.session import ship


def _sent(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    run.__name__ = query.__name__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _sent(f)
    for f in (
        mixing.op1_mix_sources,
        quality.op2_quality_rules,
        decontaminate.op3_decontaminate,
        unigram.op4_token_counts,
        htmltext.op5_extract_text,
        licenses.op7_license_scan,
        jaccard.op8_jaccard_join,
        linededup.op9_line_dedup,
        suffixdedup.op6_suffix_dedup,
        records.op10_token_records,
        suffixtree.op11_substring_dedup,
        spelling.op12_spelling_variants,
        filteraudit.op13_filter_audit,
    )
}

ORACLE: dict[str, str] = {
    "op1_mix_sources": mixing.ORACLE_OP1,
    "op3_decontaminate": decontaminate.ORACLE_OP3,
    "op9_line_dedup": linededup.ORACLE_OP9,
    "op8_jaccard_join": jaccard.ORACLE_OP8,
    "op11_substring_dedup": suffixtree.ORACLE_OP11,
    "op12_spelling_variants": spelling.ORACLE_OP12,
    "op13_filter_audit": filteraudit.ORACLE_OP13,
}
