"""tickmart: intraday market data as Spark jobs - land, validate, roll up, enrich, load, query."""
