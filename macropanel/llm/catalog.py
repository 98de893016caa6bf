"""The operators' queries for __spark_entry__.py: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from macropanel.llm import ann, conversations, license_scan, line_dedup, mixing, packing, pii, quality, runs, simhash, token_counts, toxicity, warc

QUERIES = {
    "op4_ann": ann.query,
    "op8_warc": warc.query,
    "op1_license_scan": license_scan.query,
    "op5_toxicity": toxicity.query,
    "op9_pii": pii.query,
    "op2_best_fit_packing": packing.query,
    "op3_quality_rules": quality.query,
    "op10_simhash_near_dedup": simhash.query,
    "op6_line_dedup": line_dedup.query,
    "op7_mixing": mixing.query,
    "op11_conversation_repair": conversations.query,
    "op12_token_counts": token_counts.query,
    "op13_periodic_runs": runs.query,
}

ORACLES = {
    "op8_warc": warc.ORACLE,
    "op6_line_dedup": line_dedup.ORACLE,
    "op7_mixing": mixing.ORACLE,
}
