"""Return-visit risk analytics for inpatient encounter tables, as Spark DataFrame jobs."""
