"""Column expressions: text splitting and vectors held as ARRAY<FLOAT>."""
