"""The registered query of each operator, and SQL for those that SQL can express."""

from __future__ import annotations

from faultline.llm.chat_template import OP9_SQL, op9_chat_format
from faultline.llm.embedding_dedup import op2_embedding_dedup
from faultline.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from faultline.llm.license_scan import op4_license_scan
from faultline.llm.merkle import OP13_SQL, op13_merkle
from faultline.llm.mixing import op3_mixing
from faultline.llm.packing import op10_packing
from faultline.llm.repeats import OP1_SQL, op1_repeats
from faultline.llm.sharding import op12_sharding
from faultline.llm.simhash import op7_simhash
from faultline.llm.toxicity import op6_toxicity
from faultline.llm.url_filter import op8_url_filter
from faultline.llm.whitening import op11_whitening

QUERIES = {
    "op1_repeats": op1_repeats,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_mixing": op3_mixing,
    "op4_license_scan": op4_license_scan,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_simhash": op7_simhash,
    "op8_url_filter": op8_url_filter,
    "op9_chat_format": op9_chat_format,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_sharding": op12_sharding,
    "op13_merkle": op13_merkle,
}

ORACLES = {
    "op1_repeats": OP1_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op9_chat_format": OP9_SQL,
    "op13_merkle": OP13_SQL,
}
