"""Column functions: exact arithmetic, text cleaning, dates, bands."""
