"""Reading and writing tables, CSV files and landed JSON."""
