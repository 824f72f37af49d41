"""Column functions: text cleaning, row hash, lenient dates, object keys."""
