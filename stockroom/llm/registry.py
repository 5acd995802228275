"""Query key -> callable(spark, sf_dir) -> DataFrame of the training-data operators, and their SQL."""

from __future__ import annotations

from . import mixing, sql, url_filter
from .byte_cnn import op7_byte_cnn
from .line_cleaning import op4_line_cleaning
from .ngram_jaccard import op2_ngram_jaccard
from .packing import op10_packing
from .periodic_runs import op13_periodic_runs
from .pii import op3_pii
from .secret_scan import op1_secret_scan
from .spelling_variants import op12_spelling_variants
from .spherical_caps import op6_spherical_caps
from .substring_dedup import op5_substring_dedup
from .token_store import op11_token_store

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_pii": op3_pii,
    "op4_line_cleaning": op4_line_cleaning,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_spherical_caps": op6_spherical_caps,
    "op7_byte_cnn": op7_byte_cnn,
    "op8_mixing": mixing.op8_mixing,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_packing": op10_packing,
    "op11_token_store": op11_token_store,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE = {
    "op1_secret_scan": sql.SECRETS,
    "op2_ngram_jaccard": sql.JACCARD,
    "op4_line_cleaning": sql.LINES,
    "op5_substring_dedup": sql.SUBSTRINGS,
    "op6_spherical_caps": sql.VECTORS,
    "op8_mixing": mixing.ORACLE,
    "op9_url_filter": url_filter.ORACLE,
    "op12_spelling_variants": sql.VARIANTS,
    "op13_periodic_runs": sql.RUNS,
}
