"""Reading and writing of clinical tables and results."""
