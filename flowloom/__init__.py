"""flowloom: packet and flow analytics as Spark DataFrame plans."""
