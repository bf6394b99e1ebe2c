"""Column functions: text cleaning and text metrics, all of them built-in expressions."""
