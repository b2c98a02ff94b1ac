"""Training-data operators: archives, personal data, deduplication, fingerprints,
token counts, chat formatting, quality, mixing and decontamination.

Nothing else in the package imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` registers one thin query per
operator, whose column contract the driver fixes.
"""
