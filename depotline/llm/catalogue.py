"""Importing this module registers every query of the subpackage."""

from depotline.llm import alignment, byte_bpe, compression, extraction, fingerprints, jaccard, language_model, neighbours, packing, quality, secrets, sharding, token_counts  # noqa: F401
from depotline.llm.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
