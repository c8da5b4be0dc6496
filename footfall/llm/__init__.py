"""Training-data operators: quality, toxicity, duplicates, tokens, packing.

Nothing else in the package imports this subpackage.
"""
