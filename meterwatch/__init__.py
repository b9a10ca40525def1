"""meterwatch: building-assurance audits as Spark DataFrame plans."""
