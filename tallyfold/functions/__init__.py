"""Column expressions and projections: cleaning, classification, dates."""
