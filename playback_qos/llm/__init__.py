"""Training-data operators (dedup, decontamination, PII, quality, language, tokens)."""
