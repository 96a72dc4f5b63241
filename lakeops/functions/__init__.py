"""Column -> Column cleaning expressions. All of them stay inside the JVM; none raises on bad input."""
