"""Imports every operator module, so that all queries of this subpackage are registered."""

from chartloom.llm import alignment, bpe, jaccard, language, licenses, mixture, neighbours, pages, pii, quality, repeats, toxicity, whitening  # noqa: F401  (they register)
from chartloom.llm.catalog import EXPECTED, QUERIES

__all__ = ["EXPECTED", "QUERIES"]
