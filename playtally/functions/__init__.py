"""Column functions: decoding and key formats."""
