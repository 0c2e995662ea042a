"""Column expressions: missing values, ratios, flags, label lists."""
