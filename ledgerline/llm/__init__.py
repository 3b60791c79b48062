"""Training-data operators: quality, language-model scores, near duplicates,
decontamination, licences, mixing, sharding, chat formatting, toxicity.

Nothing else in the library imports this subpackage.
"""
