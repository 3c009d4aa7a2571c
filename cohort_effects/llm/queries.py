"""The operators' queries and SQL, as ``__spark_entry__.py`` adds them."""

from __future__ import annotations

from cohort_effects.llm.op1_decontaminate import op1_decontaminate
from cohort_effects.llm.op2_suffix import op2_suffix_dedup
from cohort_effects.llm.op3_packing import op3_packing
from cohort_effects.llm.op4_quality import op4_quality
from cohort_effects.llm.op5_ngram import op5_ngram_lm
from cohort_effects.llm.op6_langid import op6_langid
from cohort_effects.llm.op7_topk import OP7_SQL, op7_topk
from cohort_effects.llm.op8_minhash import op8_minhash
from cohort_effects.llm.op9_substring import op9_substring_dedup
from cohort_effects.llm.op10_sharding import op10_sharding
from cohort_effects.llm.op11_mixing import op11_mixing
from cohort_effects.llm.op12_spelling import op12_spelling
from cohort_effects.llm.op13_manifest import op13_manifest
from cohort_effects.llm.oracle import OP12_SQL, OP13_SQL

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_packing": op3_packing,
    "op4_quality": op4_quality,
    "op5_ngram_lm": op5_ngram_lm,
    "op6_langid": op6_langid,
    "op7_topk": op7_topk,
    "op8_minhash": op8_minhash,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_sharding": op10_sharding,
    "op11_mixing": op11_mixing,
    "op12_spelling": op12_spelling,
    "op13_manifest": op13_manifest,
}

ORACLE: dict[str, str] = {
    "op7_topk": OP7_SQL,
    "op12_spelling": OP12_SQL,
    "op13_manifest": OP13_SQL,
}
