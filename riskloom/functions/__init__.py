"""Column expressions: parsing, bureau status, demographics, probabilities, scorecard."""
