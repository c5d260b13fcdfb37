"""City mobility analytics on Spark: landed feeds to conformed tables to marts."""
