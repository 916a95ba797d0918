"""The corpus operators over the whole test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from .ann import op6_ann
from .decontaminate import OP5_SQL, op5_decontaminate
from .hard_negatives import OP12_SQL, op12_hard_negatives
from .langid import op1_langid
from .lexical_search import OP13_SQL, op13_lexical_search
from .ngram_join import OP7_SQL, op7_ngram_join
from .pack_bestfit import op9_token_output
from .pack_slack import op2_pack
from .pii import OP3_SQL, op3_pii
from .quality import op8_quality
from .simhash import op11_simhash
from .suffix_dedup import op4_suffix_dedup
from .toxicity import op10_toxicity

QUERIES = {
    "op1_langid": op1_langid,
    "op2_pack": op2_pack,
    "op3_pii": op3_pii,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_ann": op6_ann,
    "op7_ngram_join": op7_ngram_join,
    "op8_quality": op8_quality,
    "op9_token_output": op9_token_output,
    "op10_toxicity": op10_toxicity,
    "op11_simhash": op11_simhash,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES = {
    "op3_pii": OP3_SQL,
    "op5_decontaminate": OP5_SQL,
    "op7_ngram_join": OP7_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_lexical_search": OP13_SQL,
}
