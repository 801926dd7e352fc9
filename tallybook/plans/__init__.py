"""Ways of laying out work that keep every task bounded on skewed data."""
