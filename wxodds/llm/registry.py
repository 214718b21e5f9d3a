"""The queries of this subpackage and, where SQL can express them, their SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wxodds.llm.queries_chat import OP10_SQL, op10_chat_format
from wxodds.llm.queries_collocations import OP11_SQL, op11_collocations
from wxodds.llm.queries_decontamination import OP7_SQL, op7_decontamination
from wxodds.llm.queries_fim import OP13_SQL, op13_fill_in_middle
from wxodds.llm.queries_html import op2_html_extract
from wxodds.llm.queries_minhash import OP12_SQL, op12_minhash_dedup
from wxodds.llm.queries_ngram import OP1_SQL, op1_ngram_join
from wxodds.llm.queries_packing import op3_packing
from wxodds.llm.queries_pii import op8_pii
from wxodds.llm.queries_quality import OP4_SQL, op4_quality_rules
from wxodds.llm.queries_sentence import op6_sentence_spans
from wxodds.llm.queries_suffix import op5_suffix_dedup
from wxodds.llm.queries_toxicity import op9_toxicity
from wxodds.llm.storage import prepare

Query = Callable[[SparkSession, str], DataFrame]


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)
    return run


QUERIES: dict[str, Query] = {q.__name__: _prepared(q) for q in (
    op1_ngram_join, op2_html_extract, op3_packing, op4_quality_rules, op5_suffix_dedup, op6_sentence_spans, op7_decontamination, op8_pii, op9_toxicity, op10_chat_format, op11_collocations,
    op12_minhash_dedup, op13_fill_in_middle)}
ORACLE: dict[str, str] = {
    "op1_ngram_join": OP1_SQL, "op4_quality_rules": OP4_SQL, "op7_decontamination": OP7_SQL, "op10_chat_format": OP10_SQL,
    "op11_collocations": OP11_SQL, "op12_minhash_dedup": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
