"""Column expressions: fixed-width formats, line packing, text normalisation."""
