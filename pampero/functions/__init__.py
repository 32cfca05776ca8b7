"""Column functions: text keys, tolerant casts, calendar, weather and score formulas."""
