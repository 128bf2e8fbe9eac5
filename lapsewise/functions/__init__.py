"""Column expressions: text, dates, amounts, segmentation rules and messages."""
