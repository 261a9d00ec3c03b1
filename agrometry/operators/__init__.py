"""Table operators: joins, bronze, silver, gold, warehouse, reports, metrics."""
