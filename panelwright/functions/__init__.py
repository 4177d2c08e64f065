"""Column functions: place labels, dates, numbers, listing text, markup."""
