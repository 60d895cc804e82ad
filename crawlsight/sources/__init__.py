"""Input schemas, table readers and the tables derived from the driver's data."""
