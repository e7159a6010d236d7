"""The complete analyses, each one function from the tables to a DataFrame."""
