"""The registered queries of the subpackage and their DuckDB equivalents.

Each query applies its operator, with production parameters, to the whole of its table.
"""

from __future__ import annotations

from footfall.llm import (
    backoff, chunked_bpe, collocations, exact_dedup, language, licences, line_spread, packing, quality, sharding,
    simhash, topk, whitening,
)
from footfall.llm.common import documents


def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


QUERIES = {
    "op1_backoff": lambda spark, sf_dir: backoff.digest(documents(spark, sf_dir)),
    "op2_quality": lambda spark, sf_dir: quality.digest(documents(spark, sf_dir), labels(spark, sf_dir)),
    "op3_topk": lambda spark, sf_dir: topk.digest(spark.read.parquet(f"{sf_dir}/embeddings.parquet")),
    "op4_language": lambda spark, sf_dir: language.digest(documents(spark, sf_dir)),
    "op5_line_spread": lambda spark, sf_dir: line_spread.digest(documents(spark, sf_dir)),
    "op6_packing": lambda spark, sf_dir: packing.digest(documents(spark, sf_dir)),
    "op7_exact_dedup": lambda spark, sf_dir: exact_dedup.digest(documents(spark, sf_dir)),
    "op8_licences": lambda spark, sf_dir: licences.digest(documents(spark, sf_dir)),
    "op9_simhash": lambda spark, sf_dir: simhash.digest(documents(spark, sf_dir)),
    "op10_bpe_chunks": lambda spark, sf_dir: chunked_bpe.digest(documents(spark, sf_dir)),
    "op11_sharding": lambda spark, sf_dir: sharding.digest(documents(spark, sf_dir)),
    "op12_collocations": lambda spark, sf_dir: collocations.digest(documents(spark, sf_dir)),
    "op13_whitening": lambda spark, sf_dir: whitening.digest(spark.read.parquet(f"{sf_dir}/embeddings.parquet")),
}

ORACLES = {
    "op1_backoff": backoff.ORACLE_SQL,
    "op3_topk": topk.ORACLE_SQL,
    "op5_line_spread": line_spread.ORACLE_SQL,
    "op7_exact_dedup": exact_dedup.ORACLE_SQL,
    "op8_licences": licences.ORACLE_SQL,
    "op12_collocations": collocations.ORACLE_SQL,
}
