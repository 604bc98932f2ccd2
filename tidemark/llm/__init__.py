"""Training-data operators: language ID, decontamination, quality, near-duplicates, WARC, licences, packing, LM scores, token files.

Nothing else in the library imports this subpackage; ``queries.py`` lists its registered queries.
"""
