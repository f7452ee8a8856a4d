"""Writers: files, catalog tables, JDBC tables."""
