"""DataFrame to DataFrame operators: reshaping, config projection, quality checks, KPIs."""
