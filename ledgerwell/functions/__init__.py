"""Column functions: text, money, dates and first-match rule chains."""
