"""Training-data operators: ten corpus operators over a ``documents`` table (doc_id, text, ...).

Nothing outside this folder imports it; :mod:`tessera.llm.entry` registers its queries.
"""
