"""Operators for large text corpora (training data preparation).

Nothing else in the library imports this subpackage.  One module per operator,
``queries`` registers them; ``corpus_pipeline.py`` at the repository top chains
five of them.
"""
