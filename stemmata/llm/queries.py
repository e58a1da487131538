"""The registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from .bpe import op1_bpe
from .bwt_dedup import op5_bwt_dedup
from .fill_in_middle import op12_fill_in_middle
from .html_text import op7_html_text
from .langid import op4_language_id
from .licenses import op3_license_scan
from .ngram_join import op8_ngram_jaccard
from .prefix_trie import op13_prefix_trie
from .quality import op2_quality_rules
from .sharding import op9_sharding
from .sql import ORACLE_SQL
from .token_files import op6_token_files
from .top_k import op11_top_k
from .wu_manber import op10_wu_manber

QUERIES = {
    f.__name__: f
    for f in (op1_bpe, op2_quality_rules, op3_license_scan, op4_language_id, op5_bwt_dedup, op6_token_files, op7_html_text, op8_ngram_jaccard, op9_sharding, op10_wu_manber, op11_top_k, op12_fill_in_middle, op13_prefix_trie)
}

__all__ = ["ORACLE_SQL", "QUERIES"]
