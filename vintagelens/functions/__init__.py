"""Column expressions: cleaning, delinquency and score interpretation."""
