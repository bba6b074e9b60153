"""The library's jobs over the driver's tables, and the SQL that each result must equal."""
