"""What is read and written: landing files, Parquet tables, snapshot tables,
append-only ledgers."""
