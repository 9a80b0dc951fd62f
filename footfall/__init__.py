"""footfall: visitor telemetry analytics expressed as Spark DataFrame operators."""
