"""Table schemas, the CSV load job and the star of tables the analyses read."""
