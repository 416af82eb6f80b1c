"""Link-graph analytics as Spark DataFrame operators."""
