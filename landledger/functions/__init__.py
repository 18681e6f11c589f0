"""Column helpers shared by the extracts, dimensions, facts and KPIs."""
