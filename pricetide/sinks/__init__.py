"""Writers: snapshot tables, landed files, CSV and JDBC."""
