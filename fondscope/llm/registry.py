"""The queries of this subpackage, for the driver's entry point."""

from __future__ import annotations

from .clustering import op11_centroid_clustering
from .collocations import op13_phrase_collocations
from .decontamination import op1_decontamination
from .grouped_packing import op12_grouped_packing
from .language import op8_language_id
from .line_dedup import op9_line_dedup
from .ngram_join import op5_ngram_jaccard_join
from .oracle import SQL
from .packed_output import op2_packed_output
from .packing import op10_best_fit_packing
from .pii import op3_pii
from .quality import op4_quality_classifier
from .search import op7_exact_topk_search
from .sharding import op6_sharding

QUERIES = {f.__name__: f for f in (op1_decontamination, op2_packed_output, op3_pii, op4_quality_classifier, op5_ngram_jaccard_join, op6_sharding, op7_exact_topk_search, op8_language_id, op9_line_dedup, op10_best_fit_packing, op11_centroid_clustering, op12_grouped_packing, op13_phrase_collocations)}

__all__ = ["QUERIES", "SQL"]
