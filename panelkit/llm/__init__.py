"""Training-data operators: ten DataFrame operators, their queries and oracles.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
