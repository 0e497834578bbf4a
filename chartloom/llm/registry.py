"""The queries of this package and their SQL twins."""

from __future__ import annotations

from chartloom.llm.byte_repeats import op11_suffix_dedup
from chartloom.llm.chat import OP1_SQL, op1_chat
from chartloom.llm.decontamination import OP8_SQL, op8_decontamination
from chartloom.llm.html_text import op7_html_text
from chartloom.llm.line_rules import OP5_SQL, op5_line_rules
from chartloom.llm.line_runs import OP10_SQL, op10_line_dedup
from chartloom.llm.lm_scoring import op6_lm_scoring
from chartloom.llm.mixing import OP2_SQL, op2_mixing
from chartloom.llm.ngram_join import OP9_SQL, op9_ngram_join
from chartloom.llm.sharding import op3_sharding
from chartloom.llm.spelling import op13_spelling
from chartloom.llm.toxicity import op4_toxicity
from chartloom.llm.word_periods import op12_word_periods

QUERIES = {
    "op1_chat": op1_chat,
    "op2_mixing": op2_mixing,
    "op3_sharding": op3_sharding,
    "op4_toxicity": op4_toxicity,
    "op5_line_rules": op5_line_rules,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_html_text": op7_html_text,
    "op8_decontamination": op8_decontamination,
    "op9_ngram_join": op9_ngram_join,
    "op10_line_dedup": op10_line_dedup,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_word_periods": op12_word_periods,
    "op13_spelling": op13_spelling,
}
ORACLES = {
    "op1_chat": OP1_SQL, "op2_mixing": OP2_SQL, "op5_line_rules": OP5_SQL, "op8_decontamination": OP8_SQL,
    "op9_ngram_join": OP9_SQL,
    "op10_line_dedup": OP10_SQL,
}
