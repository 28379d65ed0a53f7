"""Training-data operators: filtering, mixing, packing, near- and exact
duplicates, language models and page extraction. Nothing else in the library
imports this subpackage."""
