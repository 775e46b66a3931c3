"""Column expressions: path parts, LSN decoding, typed casts, list parsing."""
