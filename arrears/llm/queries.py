"""The registered queries of the text operators and their SQL twins."""

from arrears.llm.ann_forest import op7_ann_forest
from arrears.llm.bpe import op6_bpe
from arrears.llm.chat import OP4_SQL, op4_chat
from arrears.llm.merkle import OP11_SQL, op11_merkle
from arrears.llm.minhash_join import op2_minhash_join
from arrears.llm.mixing import op3_mixing
from arrears.llm.pii import op10_pii
from arrears.llm.quality_model import op8_quality_model
from arrears.llm.quality_rules import op9_quality_rules
from arrears.llm.suffix_dedup import op1_suffix_dedup
from arrears.llm.superkmer import OP12_SQL, op12_substring_dedup
from arrears.llm.turn_repair import OP13_SQL, op13_turn_repair
from arrears.llm.url_rules import OP5_SQL, op5_url_rules

QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_minhash_join, op3_mixing, op4_chat, op5_url_rules, op6_bpe, op7_ann_forest,
    op8_quality_model, op9_quality_rules, op10_pii, op11_merkle, op12_substring_dedup, op13_turn_repair)}
ORACLES = {"op4_chat": OP4_SQL, "op5_url_rules": OP5_SQL, "op11_merkle": OP11_SQL, "op12_substring_dedup": OP12_SQL, "op13_turn_repair": OP13_SQL}
