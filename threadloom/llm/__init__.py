"""Operators for preparing training data: splits, mixing, overlap, PII, duplicates, mail, threads, packing, leakage, language."""
