"""Training-data operators: packing, language identification, source mixing,
quality, near- and substring-duplicates, personal data, toxicity, vector
near-duplicates and exact search. Nothing else in the library imports this
subpackage."""
