"""Training-data operators: language ID, de-duplication, decontamination, PII, tokens, packing, WARC."""
