"""The queries of this subpackage; each takes ``(spark, sf_dir)``."""

from functools import wraps

from sitewatch.llm.common import prepare
from sitewatch.llm.op10_urls import op10_urls
from sitewatch.llm.op11_vector import op11_vector
from sitewatch.llm.op12_repair import op12_repair
from sitewatch.llm.op13_alignment import op13_alignment
from sitewatch.llm.op1_repeats import op1_repeats
from sitewatch.llm.op2_templates import op2_templates
from sitewatch.llm.op3_language import op3_language
from sitewatch.llm.op4_cascade import op4_cascade
from sitewatch.llm.op5_sharding import op5_sharding
from sitewatch.llm.op6_toxicity import op6_toxicity
from sitewatch.llm.op7_dac import op7_dac
from sitewatch.llm.op8_minhash import op8_minhash
from sitewatch.llm.op9_packing import op9_packing
from sitewatch.llm.oracles import ORACLES

_ALL = (
    op1_repeats, op2_templates, op3_language, op4_cascade, op5_sharding, op6_toxicity, op7_dac,
    op8_minhash, op9_packing, op10_urls, op11_vector, op12_repair,
    op13_alignment,
)


def _shared(query):
    @wraps(query)
    def run(spark, sf_dir):
        prepare(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {query.__name__: _shared(query) for query in _ALL}

__all__ = ["ORACLES", "QUERIES"]
