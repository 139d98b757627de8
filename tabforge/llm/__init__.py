"""Training-data operators: near-duplicates, sharding, language, tokens,
fingerprints, toxicity, personal data and packing.

Nothing outside this package imports it.  ``queries`` registers one driver
query per operator; ``corpus_pipeline.py`` at the repository top chains
five of them.
"""
