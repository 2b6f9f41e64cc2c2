"""Writers: topic, JDBC, tables, materialised views, metrics store."""
