"""Training-data operators: classifiers, secret scans, near-duplicates,
mixing, language identification, extraction, vector search and packing.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
