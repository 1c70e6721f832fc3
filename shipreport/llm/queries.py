"""All queries of this subpackage: importing it registers them."""

from . import cotraining, fingerprints, importance, lexical_search, license_scan, near_dedup, page_text, sentencepieces, source_mixing, suffix_dedup, text_rules, token_counts, vector_dedup  # noqa: F401
from .common import ORACLE, QUERIES  # noqa: F401
