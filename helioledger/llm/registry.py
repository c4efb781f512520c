"""The registered queries of this subpackage and their DuckDB statements, where SQL can express them."""

from __future__ import annotations

from helioledger.llm.bpe import op10_byte_level_bpe
from helioledger.llm.centroids import OP12_SQL, op12_equal_average_clusters
from helioledger.llm.langid import op1_evidence_fusion
from helioledger.llm.mixing import op3_temperature_mixing
from helioledger.llm.packing import op11_sum_of_squares_packing
from helioledger.llm.phrases import OP13_SQL, op13_setm_collocations
from helioledger.llm.quality import op2_distribution_divergence
from helioledger.llm.secrets import op9_structural_confirmation
from helioledger.llm.sharding import op4_rendezvous_sharding
from helioledger.llm.simhash import op7_meet_in_the_middle_simhash
from helioledger.llm.suffixes import OP6_SQL, op6_prefix_partitioned_suffixes
from helioledger.llm.topk import OP5_SQL, op5_histogram_top_k
from helioledger.llm.wrappers import op8_wrapper_induction

_QUERIES = (
    op1_evidence_fusion,
    op2_distribution_divergence,
    op3_temperature_mixing,
    op4_rendezvous_sharding,
    op5_histogram_top_k,
    op6_prefix_partitioned_suffixes,
    op7_meet_in_the_middle_simhash,
    op8_wrapper_induction,
    op9_structural_confirmation,
    op10_byte_level_bpe,
    op11_sum_of_squares_packing,
    op12_equal_average_clusters,
    op13_setm_collocations,
)


def queries() -> dict:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        op5_histogram_top_k.__name__: OP5_SQL,
        op6_prefix_partitioned_suffixes.__name__: OP6_SQL,
        op12_equal_average_clusters.__name__: OP12_SQL,
        op13_setm_collocations.__name__: OP13_SQL,
    }
