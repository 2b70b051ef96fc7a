"""Column functions: text, geography, dates, numbers and missing-value comparisons."""
