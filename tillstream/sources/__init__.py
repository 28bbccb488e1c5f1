"""Where rows come from: tables, record mappings, topics, JDBC."""
