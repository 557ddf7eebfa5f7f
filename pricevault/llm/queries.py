"""All queries of this subpackage."""

from pricevault.llm import q_counts, q_html, q_manifest, q_minhash, q_model, q_packing, q_quality, q_repeats, q_tokens, q_urls, q_vectors, q_whitening  # noqa: F401  (they register)
from pricevault.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
