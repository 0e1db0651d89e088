"""Column-expression building blocks (indicator formulas, JSON validation, rounding)."""
