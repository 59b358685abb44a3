"""Operators of a training-data pipeline: near-duplicates, repeated passages,
quality, packing, personal data, decontamination, chat formatting, language
and main-text extraction. Nothing outside this subpackage imports it."""
