"""Training-data operators: filtering, deduplication, scoring, packing.

Nothing else in the library imports this package; deleting it (together with
``tests/llm`` and ``corpus_pipeline.py``) leaves the rest working.
"""
