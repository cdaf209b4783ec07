"""Analytics over daily gridded climate-model output, expressed as Spark DataFrame transformations."""
