"""Column functions: text keys, clock arithmetic, calendar periods."""
