"""Query-intent labelling and label-quality measurement as Spark DataFrame jobs."""
