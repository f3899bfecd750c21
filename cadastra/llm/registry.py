"""The queries of this subpackage, for the driver's registry."""

from __future__ import annotations

from .chunk_dedup import op6_chunk_dedup
from .conversation_repair import op13_conversation_repair
from .decontaminate import op5_decontaminate
from .exact_dedup import OP3_SQL, op3_exact_dedup
from .impact_search import OP11_SQL, op11_impact_search
from .language_id import op2_language_id
from .line_dedup import op8_line_dedup
from .minhash_dedup import op10_minhash_dedup
from .mixing import op4_mixing
from .suffix_dedup import op9_suffix_dedup
from .suffix_tree_lm import op1_suffix_tree_lm
from .token_records import op7_token_records
from .weighted_sampling import op12_weighted_sampling

_OPERATORS = {
    "op1_suffix_tree_lm": op1_suffix_tree_lm,
    "op2_language_id": op2_language_id,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_mixing": op4_mixing,
    "op6_chunk_dedup": op6_chunk_dedup,
    "op7_token_records": op7_token_records,
    "op8_line_dedup": op8_line_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op12_weighted_sampling": op12_weighted_sampling,
}


def queries() -> dict:
    def over_documents(op):
        return lambda spark, sf_dir: op(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))

    found = {name: over_documents(op) for name, op in _OPERATORS.items()}
    found["op5_decontaminate"] = lambda spark, sf_dir: op5_decontaminate(
        spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
    found["op11_impact_search"] = lambda spark, sf_dir: op11_impact_search(
        spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
    found["op13_conversation_repair"] = lambda spark, sf_dir: op13_conversation_repair(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return found


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": OP3_SQL, "op11_impact_search": OP11_SQL}
