"""Column expressions: text repair, casts, labels and date keys."""
