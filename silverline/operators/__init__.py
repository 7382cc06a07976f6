"""Row-set operators: bronze metadata and status, routing, derived tables, repairs, quality."""
