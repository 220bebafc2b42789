"""Training-data operators: clean, score, deduplicate, mix, format and encode documents."""
