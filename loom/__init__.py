"""Representative-set, coupling and training-data analytics as Spark DataFrame plans."""
