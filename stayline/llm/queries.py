"""Imports every operator module, so that its query is registered."""

from stayline.llm import divergence, exact_dedup, html_text, lang_id, line_dedup, mixing, pii, prob_minhash, quality, spelling, token_files, trie_bpe, url_filter  # noqa: F401
from stayline.llm.registry import ORACLE, QUERIES  # noqa: F401
