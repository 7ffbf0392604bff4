"""All queries of the subpackage; importing this module registers them."""

from roadflow.llm import q_corpus, q_exact, q_text, q_words  # noqa: F401
from roadflow.llm.registry import CHECKS, QUERIES  # noqa: F401
