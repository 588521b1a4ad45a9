"""dqspark: a retail-sales warehouse and its data-quality checks as Spark DataFrame operators."""
