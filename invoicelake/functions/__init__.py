"""Column functions: text clean-up, number reading, exact sums."""
