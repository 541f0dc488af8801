"""Column -> Column functions and small shared plan fragments."""
