"""Training-data operators: ten corpus operators and their queries.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
