"""Registered queries of this subpackage and their oracle SQL."""

from tidefold.llm import chat, decontaminate, filter_audit, repeats, revisits, topk
from tidefold.llm.chat import op12_chat
from tidefold.llm.decontaminate import op1_decontaminate
from tidefold.llm.filter_audit import op13_filters
from tidefold.llm.language import op5_language
from tidefold.llm.packing import op2_packing
from tidefold.llm.repair import op11_repair
from tidefold.llm.repeats import op9_repeats
from tidefold.llm.secrets import op3_secrets
from tidefold.llm.revisits import op7_revisits
from tidefold.llm.simhash import op8_simhash
from tidefold.llm.surrogates import op4_surrogates
from tidefold.llm.token_counts import op10_token_counts
from tidefold.llm.topk import op6_topk

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_packing": op2_packing,
    "op3_secrets": op3_secrets,
    "op4_surrogates": op4_surrogates,
    "op5_language": op5_language,
    "op6_topk": op6_topk,
    "op7_revisits": op7_revisits,
    "op8_simhash": op8_simhash,
    "op9_repeats": op9_repeats,
    "op10_token_counts": op10_token_counts,
    "op11_repair": op11_repair,
    "op12_chat": op12_chat,
    "op13_filters": op13_filters,
}

ORACLES = {
    "op1_decontaminate": decontaminate.ORACLE,
    "op6_topk": topk.ORACLE,
    "op7_revisits": revisits.ORACLE,
    "op9_repeats": repeats.ORACLE,
    "op12_chat": chat.ORACLE,
    "op13_filters": filter_audit.ORACLE,
}
