"""Training-data operators: sharding, fingerprints, classifiers, deduplication,
decontamination, language identification, packing and token counts.

Nothing else in the library imports this subpackage.
"""
