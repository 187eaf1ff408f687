"""Training-data operators: cleaning, filtering, de-duplication, sharding and tokenising of text corpora.

Nothing outside this subpackage imports it; its queries are listed in :mod:`tidemark.llm.queries`.
"""
