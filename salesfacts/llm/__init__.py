"""Training-data operators on Spark: tokenising, search, extraction, deduplication,
scanning, packing and language-model scoring. Nothing else in the library imports
this package; its queries are listed in ``salesfacts.llm.queries``."""
