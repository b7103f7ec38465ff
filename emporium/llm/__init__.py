"""Training-data operators: quality, decontamination, deduplication, scans,
extraction and tokenization. Nothing outside this package imports it."""
