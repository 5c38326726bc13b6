"""Column expressions: tokenizers, scoring formulas and text clean-up."""
