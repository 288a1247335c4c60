"""Registered queries (one module per operator family)."""

from vitrine.plans.registry import REGISTRY, query  # noqa: F401
from vitrine.plans import q_text, q_eda, q_vec, q_eval, q_split, q_num, q_img, q_models, q_io, q_lang  # noqa: F401
