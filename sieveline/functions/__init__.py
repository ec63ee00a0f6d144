"""Column functions: text cleaning, classification, records."""
