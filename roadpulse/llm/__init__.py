"""Training-data operators: quality, safety, licences, language, duplicates, packing."""
