"""Queries and their SQL over the given tables."""

from __future__ import annotations

import functools

from busgrid.llm.audit import OP13_SQL, op13_filter_audit
from busgrid.llm.bpe import op5_bpe
from busgrid.llm.common import bound_batches
from busgrid.llm.jaccard import OP9_SQL, op9_jaccard
from busgrid.llm.langid import op6_language
from busgrid.llm.middle import OP12_SQL, op12_fill_in_middle
from busgrid.llm.mixing import OP7_SQL, op7_mixing
from busgrid.llm.pii import OP2_SQL, op2_pii
from busgrid.llm.pivots import OP4_SQL, op4_top_k
from busgrid.llm.quality import op10_quality
from busgrid.llm.repeats import OP8_SQL, op8_repeats
from busgrid.llm.simhash import op11_simhash
from busgrid.llm.token_files import op3_token_files
from busgrid.llm.toxicity import op1_toxicity


def _bounded(query):
    @functools.wraps(query)
    def run(spark, sf_dir):
        bound_batches(spark)
        return query(spark, sf_dir)

    return run


_QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_pii": op2_pii,
    "op3_token_files": op3_token_files,
    "op4_top_k": op4_top_k,
    "op5_bpe": op5_bpe,
    "op6_language": op6_language,
    "op7_mixing": op7_mixing,
    "op8_repeats": op8_repeats,
    "op9_jaccard": op9_jaccard,
    "op10_quality": op10_quality,
    "op11_simhash": op11_simhash,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_filter_audit": op13_filter_audit,
}
QUERIES = {name: _bounded(query) for name, query in _QUERIES.items()}

#: The other operators learn from labels, call tokenizer libraries or hash as SQL cannot.
SQL = {
    "op2_pii": OP2_SQL,
    "op4_top_k": OP4_SQL,
    "op7_mixing": OP7_SQL,
    "op8_repeats": OP8_SQL,
    "op9_jaccard": OP9_SQL,
    "op12_fill_in_middle": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
