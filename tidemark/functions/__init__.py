"""Column functions: names, codes, dates, amounts and printed rules."""
