"""Reading and writing table sets and versions."""
