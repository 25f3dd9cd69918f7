"""Column expressions. All of them are built from Spark SQL functions except
the two string distances in :mod:`bibweave.functions.distance`."""
