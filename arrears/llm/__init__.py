"""Training-data operators: dedup, mixing, chat formatting, URL rules, BPE, search, quality and PII."""
