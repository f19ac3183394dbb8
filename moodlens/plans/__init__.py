"""Query catalogue: what runs over the driver's tables, with a SQL twin where SQL can say it."""
