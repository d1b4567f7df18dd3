"""Column expressions: text, time, numbers, places, sentiment, tokens, links, nested data."""
