"""The queries of this subpackage, and their SQL."""

from __future__ import annotations

from rillstone.llm.bpe import op8_bpe
from rillstone.llm.decontaminate import op7_decontamination
from rillstone.llm.embeddings import ORACLE_OP3, op3_embeddings
from rillstone.llm.hpylm import op5_lm_scores
from rillstone.llm.langid import op4_language
from rillstone.llm.licenses import ORACLE_OP1, op1_license_scan
from rillstone.llm.linededup import ORACLE_OP6, op6_line_dedup
from rillstone.llm.minhash import ORACLE_OP9, op9_minhash
from rillstone.llm.patricia import ORACLE_OP13, op13_exact_dedup
from rillstone.llm.sharding import op10_sharding
from rillstone.llm.toxicity import op2_toxicity
from rillstone.llm.vafile import ORACLE_OP11, op11_clustering
from rillstone.llm.whitening import op12_whitening

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_toxicity": op2_toxicity,
    "op3_embeddings": op3_embeddings,
    "op4_language": op4_language,
    "op5_lm_scores": op5_lm_scores,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_bpe": op8_bpe,
    "op9_minhash": op9_minhash,
    "op10_sharding": op10_sharding,
    "op11_clustering": op11_clustering,
    "op12_whitening": op12_whitening,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLES = {
    "op1_license_scan": ORACLE_OP1,
    "op3_embeddings": ORACLE_OP3,
    "op6_line_dedup": ORACLE_OP6,
    "op9_minhash": ORACLE_OP9,
    "op11_clustering": ORACLE_OP11,
    "op13_exact_dedup": ORACLE_OP13,
}
