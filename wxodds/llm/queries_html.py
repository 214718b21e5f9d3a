"""op2_html_extract: the main text of all pages; SQL can't walk markup, see tests/llm."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxodds.llm.html_extract import extract
from wxodds.llm.storage import load


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(load(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
