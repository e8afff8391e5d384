"""Column functions: codes, text, amounts, rules and messages."""
