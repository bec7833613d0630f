"""Operators of a training-data pipeline (URL filters, chat formatting,
substring and near-duplicate removal, sketches, byte-level BPE, PII, secret
scans, decontamination, quality). Nothing outside this package imports it."""
