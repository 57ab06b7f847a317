"""Query plans: the named queries of SURVEY §2 and the two end-to-end pipelines."""

from . import q_eval, q_features, q_io, q_models, q_profile, q_text, q_tfidf  # noqa: F401  (registers queries)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
