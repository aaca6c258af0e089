"""Sources: file listings, delimited files, sheets, tables and the column catalog."""
