"""Training-data operators: decontamination, toxicity, secrets, personal data,
near and exact duplicates, token counts, packing, sharding, chat formatting,
whitening, main texts of pages, phrase collocations.

Nothing else in the library imports this subpackage."""
