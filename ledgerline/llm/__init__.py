"""Training-data operators: chat formatting, near-duplicate removal, tokens, language, packing, search."""
