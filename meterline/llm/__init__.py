"""Training-data operators: tokens, archives, quality, private data, main text, secrets, copies, packing, toxicity."""
