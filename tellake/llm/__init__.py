"""Training-data operators: mixing, quality, language, near duplicates, decontamination, scoring, packing.

Nothing outside this subpackage imports it.
"""
