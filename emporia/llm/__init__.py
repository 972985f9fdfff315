"""Operators of a training-data pipeline, and their registered queries.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it; the entry
module adds its queries only when the folder is present.
"""
