"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from tallyfold.llm.bpe import op6_byte_bpe
from tallyfold.llm.chunking import op8_chunk_dedup
from tallyfold.llm.mih import op1_multi_index_hashing
from tallyfold.llm.packing import op9_best_two_fit
from tallyfold.llm.partenum import op10_partenum_join
from tallyfold.llm.phrases import OP13_SQL, op13_collocations
from tallyfold.llm.pu_quality import op12_nnpu_quality
from tallyfold.llm.quality import OP5_SQL, op5_quality_rules
from tallyfold.llm.repair import op11_conversation_repair
from tallyfold.llm.secrets import op4_secret_ledger
from tallyfold.llm.sharding import op2_stratified_shards
from tallyfold.llm.suffixes import op3_suffix_dedup
from tallyfold.llm.wordpiece import op7_wordpiece_counts

QUERIES = {
    "op1_multi_index_hashing": op1_multi_index_hashing,
    "op2_stratified_shards": op2_stratified_shards,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_secret_ledger": op4_secret_ledger,
    "op5_quality_rules": op5_quality_rules,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_wordpiece_counts": op7_wordpiece_counts,
    "op8_chunk_dedup": op8_chunk_dedup,
    "op9_best_two_fit": op9_best_two_fit,
    "op10_partenum_join": op10_partenum_join,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_nnpu_quality": op12_nnpu_quality,
    "op13_collocations": op13_collocations,
}
#: The others can't be expressed in SQL; tests/llm holds them against brute force.
ORACLES = {
    "op5_quality_rules": OP5_SQL,
    "op13_collocations": OP13_SQL,
}
