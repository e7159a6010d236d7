"""Column-level building blocks: dates, exact arithmetic, text and labels."""
