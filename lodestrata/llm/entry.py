"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from lodestrata.llm.bpe import op4
from lodestrata.llm.exact import OP9_SQL, op9
from lodestrata.llm.linededup import OP7_SQL, op7
from lodestrata.llm.packing import op8
from lodestrata.llm.pii import op1
from lodestrata.llm.quality import op6
from lodestrata.llm.secrets import op3
from lodestrata.llm.sharding import op5
from lodestrata.llm.simhash import op2
from lodestrata.llm.toxicity import op10

QUERIES = {"op1_pii_disclosure": op1, "op2_simhash_near_dedup": op2, "op3_secret_scan": op3, "op4_byte_bpe": op4, "op5_kd_sharding": op5, "op6_quality_rules": op6, "op7_line_dedup": op7, "op8_best_fit_packing": op8, "op9_exact_dedup": op9, "op10_toxicity": op10}
ORACLE_SQL = {"op7_line_dedup": OP7_SQL, "op9_exact_dedup": OP9_SQL}


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
